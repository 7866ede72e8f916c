"""Patterns, seasonal forecast and change points against plain loops."""

import datetime as dt
import random
from itertools import combinations

import numpy as np

from medalla.operators import patterns as P
from medalla.operators import seasonal as S


def test_rules_against_counts(spark):
    r = random.Random(2)
    rows = [(r.choice("ab"), r.choice("xyz"), r.choice(["p", "p", None])) for _ in range(200)]
    df = spark.createDataFrame(rows, "t string, u string, v string")
    bags = [frozenset(f"{n}={x}" for n, x in zip("tuv", row) if x) for row in rows]
    sets = {}
    for k in (1, 2, 3):
        for b in bags:
            for c in combinations(sorted(b), k):
                sets[c] = sets.get(c, 0) + 1
    sets = {c: n for c, n in sets.items() if n >= 20}
    assert {(x.conjunto, x.elementos, x.quejas) for x in P.frequent_sets(df, ("t", "u", "v"), 0.1).collect()} == {
        (" & ".join(c), len(c), n) for c, n in sets.items()}
    want = set()
    for c, n in sets.items():
        for item in c:
            rest = tuple(x for x in c if x != item)
            if rest and n / sets[rest] >= 0.4:
                want.add((" & ".join(rest), item, round(n / 200, 6), round(n / sets[rest], 6), round(n / sets[rest] / (sets[item,] / 200), 6)))
    assert {tuple(x) for x in P.association_rules(df, ("t", "u", "v"), 0.1, 0.4).collect()} == want
    assert P.frequent_sets(df.limit(0), ("t", "u", "v")).count() == 0


def smooth(x, a, b, g):
    first, second = sum(x[:12]) / 12, sum(x[12:24]) / 12
    level, trend, season, sse = first, (second - first) / 12, [v - first for v in x[:12]], 0.0
    for v in x[12:]:
        due = season.pop(0)
        sse += (v - level - trend - due) ** 2
        new = a * (v - due) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        level = new
        season.append(g * (v - level) + (1 - g) * due)
    return sse, level, trend, season


def _month(i):
    return dt.date(2010 + i // 12, i % 12 + 1, 1)


def test_forecast_against_a_loop(spark):
    r = random.Random(5)
    series = {"a": [50 + i + 20 * np.sin(i * np.pi / 6) + r.random() for i in range(40)], "b": [float(r.randrange(9)) for _ in range(25)],
              None: [7.0] * 24, "short": [1.0] * 23}
    rows = [(k, _month(i), float(v)) for k, x in series.items() for i, v in enumerate(x) if not (k == "b" and i == 5)]
    series["b"][5] = 0.0  # a month without a row
    df = spark.createDataFrame(rows, "k string, d date, v double")
    got = {(x.k, x.paso): x for x in S.seasonal_forecast(df, ["k"], "d", "v").collect()}
    assert {k for k, _ in got} == {"a", "b", None} and len(got) == 9
    for k in ("a", "b", None):
        x = series[k]
        best = min(S.GRID, key=lambda p: smooth(x, *p)[0])
        sse, level, trend, season = smooth(x, *best)
        for h in (1, 2, 3):
            f = got[k, h]
            assert (f.alfa, f.beta, f.gama) == best or abs(smooth(x, f.alfa, f.beta, f.gama)[0] - sse) < 1e-9
            assert abs(f.prediccion - (level + h * trend + season[h - 1])) < 1e-4 and f.fecha == _month(len(x) + h - 1)
            assert abs(f.error_estacional - (sse / (len(x) - 12)) ** 0.5) < 1e-5
            flat = sum((x[t] - sum(x[t - 6:t]) / 6) ** 2 for t in range(12, len(x)))
            assert abs(f.error_plano - (flat / (len(x) - 12)) ** 0.5) < 1e-5
    assert got["a", 1].error_estacional < got["a", 1].error_plano


def test_segments_against_all_cuts():
    r = random.Random(8)
    for n in (1, 5, 6, 11, 13):
        for _ in range(12):
            x = np.array([float(r.choice([0, 0, 5, 9]) + r.randrange(2)) for _ in range(n)])
            penalty, least = r.choice([0.5, 4.0, 30.0]), 2
            best = (float("inf"),)
            for k in range(n):
                for cuts in combinations(range(1, n), k):
                    runs = list(zip([0, *cuts], [*cuts, n]))
                    if k and min(b - a for a, b in runs) < least:
                        continue
                    best = min(best, (sum(((x[a:b] - x[a:b].mean()) ** 2).sum() + penalty for a, b in runs),))
            got = S.segments(x, penalty, least)
            assert got[0][0] == 0 and got[-1][1] == n and all(a[1] == b[0] for a, b in zip(got, got[1:]))
            assert abs(sum(((x[a:b] - x[a:b].mean()) ** 2).sum() + penalty for a, b in got) - best[0]) < 1e-6


def test_two_years_with_a_level_shift(spark):
    rows = [("a", _month(i), 10 + i % 2 + (30 if i >= 14 else 0)) for i in range(24)] + [(None, _month(3), 5), (None, _month(3), 2), ("z", None, 1)]
    df = spark.createDataFrame(rows, "k string, d date, v long")
    got = sorted((tuple(r) for r in S.change_points(df, ["k"], "d", "v").collect()), key=str)
    assert got == [("a", 1, _month(0), _month(13), 14, 147.0, 10.5, None), ("a", 2, _month(14), _month(23), 10, 405.0, 40.5, 30.0),
                   (None, 1, _month(3), _month(3), 1, 7.0, 7.0, None)]
    assert S.change_points(df.limit(0), ["k"], "d", "v").count() == 0


def test_equal_rows_are_one_transaction(spark):
    """What is mined does not grow with the rows."""
    rows = [("a", "x"), ("a", None), ("b", "x")]
    for k in (1, 50):
        got = P.transactions(spark.createDataFrame(rows * k, "t string, u string"), ("t", "u")).collect()
        assert sorted((list(r["items"]), r["n"]) for r in got) == [(["t=a"], k), (["t=a", "u=x"], k), (["t=b", "u=x"], k)]


def test_checks_cut_the_series_once(spark):
    df = spark.createDataFrame([("a", _month(i), 5) for i in range(8)] + [(None, _month(1), 3)], "k string, d date, v long")
    checks = S.change_checks(S.change_points(df, ["k"], "d", "v"), df, ["k"], "d", "v")
    assert "InPandas" not in checks._jdf.queryExecution().optimizedPlan().toString()
    assert {r.control: r.valor for r in checks.collect()} == {"series": 2, "meses": 9, "total": 43, "huecos": 0, "totales_distintos": 0}
