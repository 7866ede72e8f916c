"""MinHash near duplicates of short texts: nothing may be lost."""

import random

import numpy as np
from test_minhash_dedup import brute

from medalla.llm import minhash_dedup as md


def test_minima_are_independent_for_small_sets():
    rng = np.random.default_rng(4)
    for both, union, percent in ((6, 7, 85), (9, 10, 85), (17, 20, 85), (4, 5, 80), (8, 10, 80), (16, 20, 80)):
        radius = 2 * (md.SYMBOLS // md.width_for(percent)) - 1
        away = []
        for _ in range(1500):
            s = rng.integers(0, 1 << 64, union, dtype=np.uint64)
            away.append((md.signature(s) != md.signature(s[:both])).sum())
        q = 1 - both / union
        assert max(away) <= radius, (both, union)
        assert abs(np.mean(away) - 60 * q) < 0.5 and np.std(away) < 1.15 * (60 * q * (1 - q)) ** 0.5


def test_width_follows_the_percentage():
    assert [md.width_for(p) for p in (95, 85, 80, 70, 50)] == [5, 5, 4, 3, 2]
    rng = np.random.default_rng(0)
    for width in (2, 3, 4):
        a = rng.integers(0, 1 << 16, md.SYMBOLS).astype("<u2")
        b = a.copy()
        at = rng.choice(md.SYMBOLS, 2 * (md.SYMBOLS // width) - 1, replace=False)
        b[at] ^= 1
        e = md.entries(np.stack([a, b]), width)
        assert set(e[0]) & set(e[1])


def test_short_texts_against_brute_force(spark):
    rnd = random.Random(8)
    for size, percent in ((3, 85), (5, 80)):
        rows = []
        for g in range(400):  # pairs of which one has a word more or another last word
            words = [f"w{rnd.randrange(10_000)}" for _ in range(rnd.randrange(5, 41))]
            other = words + [f"x{g}"] if g % 2 else words[:-1] + [f"x{g}"]
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
        got = md.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size, percent).collect()
        want = brute(rows, size, percent)
        assert sum(d != c for d, _, c in want) > 200
        assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(want)
