"""Embedding near-dedup against all pairs (the SQL check covers the table)."""

import numpy as np

from medalla.llm import embedding_dedup as ed


def brute(rows, cosine):
    ok = [i for i, (v, e, lab) in enumerate(rows) if lab is not None and e and None not in e and np.isfinite(e).all() and any(e)]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for x in ok:
        for y in ok:
            (u, a, p), (v, b, q) = rows[x], rows[y]
            if x < y and p == q and len(a) == len(b):
                a, b = np.array(a, float), np.array(b, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                    links[x] += 1
                    links[y] += 1
                    root[find(x)] = find(y)
            if x < y and u is not None and u == v:
                root[find(x)] = find(y)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(r[0], low.get(find(i), r[0]))
    return [(r[0], links[i], low.get(find(i)) if i in ok else r[0]) for i, r in enumerate(rows)]


def check(spark, rows, cosine):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, node int, low string")
    got = ed.near_vectors(df, cosine).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute(rows, cosine), key=key)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ed, "BLOCK", 16)
    monkeypatch.setattr(ed, "LEAF", 4)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(25):
        c = rng.normal(size=8)
        for _ in range(rng.integers(1, 14)):
            rows.append((len(rows), (c + rng.normal(size=8) * rng.choice([0.02, 0.1, 0.3])).tolist(), int(i % 3)))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(40)]  # copies
    e = rows[1][1]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 8, 1), (2003, [float("nan")] + e[1:], 1),
             (2004, [float("inf")] + e[1:], 1), (2005, [None] + e[1:], 1), (2006, e, None), (2007, e[:7], rows[1][2]),
             (2008, [x * 1e200 for x in e], rows[1][2]), (2009, [x * 1e-200 for x in e], rows[1][2]),
             (None, e, rows[1][2]), (2010, e, rows[1][2]), (2010, rows[30][1], rows[30][2]), (2011, [-x for x in e], rows[1][2])]
    check(spark, rows, 0.98)
    check(spark, rows, 0.5)


def test_empty_and_all_bad(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert ed.near_vectors(df).count() == 0
    check(spark, [(1, None, 1), (2, [0.0], 1)], 0.98)
