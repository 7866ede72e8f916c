"""MinHash near duplicates: pigeonhole, brute force, edge cases."""

import random

import numpy as np

from medalla.llm import minhash_dedup as md


def test_entries_meet_within_the_radius():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, md.SYMBOLS).astype("<u2")
        b = a.copy()
        at = rng.choice(md.SYMBOLS, md.RADIUS, replace=False)
        b[at] ^= rng.integers(1, 1 << 16, md.RADIUS).astype("<u2")
        e = md.entries(np.stack([a, b]))
        assert set(e[0]) & set(e[1])
        c = a.copy()
        c[:: md.WIDTH] ^= 1
        c[1:: md.WIDTH] ^= 1  # two errors in every chunk
        e = md.entries(np.stack([a, c]))
        assert not set(e[0]) & set(e[1])


def brute(rows, size, percent):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w)} if 0 < len(w) < size else {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            both = len(sets[i] & sets[j])
            if same or sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(d, len(s), low.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def near_copies(seed, groups=12, words=60):
    rnd = random.Random(seed)
    rows, vocabulary = [], [f"w{i}" for i in range(400)]
    for g in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(words)]
        for k in range(rnd.choice([1, 2, 5, 30])):
            t = base.copy()
            for _ in range(rnd.randrange(0, 5)):
                t[rnd.randrange(words)] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(t)))
    rnd.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    for size, percent in ((3, 85), (5, 80)):
        rows = near_copies(size) + [(9001, None), (9002, ""), (9003, " \t\n"), (9004, "one"), (9005, "ONE"),
                                    (9006, "one two"), (9006, "one two"), (None, "one two"), (None, "null id only here"),
                                    (9007, "a b c d"), (9008, "x y z " * 30000), (9009, "x y z " * 30001)]
        df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, root int, sig string")
        got = md.near_duplicates(df, size, percent).collect()
        want = brute(rows, size, percent)
        key = lambda r: tuple((x is None, x or 0) for x in r)
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(want, key=key)
        assert all(r.kept == (r.doc_id is not None and r.doc_id == r.component_id) for r in got)
        kept = md.keep_one(df, size, percent)
        assert kept.columns == df.columns
        assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
            {r.doc_id for r in got if r.kept})


def test_blocks_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(md, "BLOCK", 8)
    rows = near_copies(7, groups=4)
    got = md.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute(rows, 3, 85))


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert md.near_duplicates(df).count() == 0 and md.keep_one(df).count() == 0
