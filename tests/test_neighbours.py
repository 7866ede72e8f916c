"""Nearest peers against all pairs."""

import math
import random

from medalla.operators import neighbours as N


def brute(rows, k):
    out = set()
    ok = [r for r in rows if all(v is not None and v == v for v in r[2:])]
    for i, a in enumerate(ok):
        far = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(a[2:], b[2:]))), b[0] is not None, b[0] or "", b[1])
                     for j, b in enumerate(ok) if j != i)
        out |= {(a[0], a[1], b if some else None, c, p + 1, round(d, 6)) for p, (d, some, b, c) in enumerate(far[:k])}
    return out


def fixture(n, seed):
    r = random.Random(seed)
    rows = [(f"n{i % 7}" if i % 11 else None, i, r.gauss(i % 4, 0.1), float(r.randrange(3)), r.expovariate(1)) for i in range(n)]
    rows += [("same", 1000 + i, 2.0, 1.0, 0.5) for i in range(60)]  # many at one place
    return [*rows, ("far", 2000, 500.0, -500.0, 0.0), ("null", 2001, None, 1.0, 1.0), ("nan", 2002, float("nan"), 1.0, 1.0)]


SCHEMA = "name string, no long, a double, b double, c double"


def test_equals_all_pairs(spark):
    rows = fixture(400, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    for k, pivots, block in ((5, 16, 1024), (3, 5, 32), (1, 1, 50)):
        got = N.nearest(df, ["name", "no"], ["a", "b", "c"], k, pivots, block).collect()
        assert {tuple(r) for r in got} == brute(rows, k) and len(got) == 461 * k


def test_small_and_empty(spark):
    df = spark.createDataFrame(fixture(3, 2)[:3], SCHEMA)
    assert N.nearest(df, ["name", "no"], ["a", "b", "c"], 5).count() == 6
    assert N.nearest(df.limit(1), ["name", "no"], ["a", "b", "c"], 5).count() == 0
    assert N.nearest(df.limit(0), ["name", "no"], ["a", "b", "c"], 5).count() == 0
