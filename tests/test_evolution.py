"""Clusters over time: assignment, matching, transitions."""

import random
from itertools import permutations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from medalla.operators import evolution as V
from medalla.plans import registry


def test_assignment_is_the_cheapest_of_all_orders():
    r = random.Random(7)
    for _ in range(200):
        rows, cols = r.randrange(1, 6), r.randrange(1, 6)
        cost = [[r.choice([r.random(), float(r.randrange(3))]) for _ in range(cols)] for _ in range(rows)]
        got = V.assignment(cost)
        taken = [j for j in got if j >= 0]
        assert len(taken) == len(set(taken)) == min(rows, cols)
        flat = cost if rows <= cols else [list(x) for x in zip(*cost)]
        best = min(sum(flat[i][j] for i, j in enumerate(p)) for p in permutations(range(len(flat[0])), len(flat)))
        assert abs(sum(cost[i][j] for i, j in enumerate(got) if j >= 0) - best) < 1e-9
    assert V.assignment([]) == []


def test_tracks_follow_the_centres():
    centers = {(1, 0): (0.0,), (1, 1): (10.0,), (2, 0): (9.0,), (2, 1): (1.0,), (2, 2): (50.0,), (3, 0): (51.0,)}
    got = {(g, j): (t, d) for g, j, t, d in V.match_centers(centers)}
    assert got == {(1, 0): (0, None), (1, 1): (1, None), (2, 0): (1, 1.0), (2, 1): (0, 1.0), (2, 2): (2, None), (3, 0): (2, 1.0)}


def _points(spark, rows):
    return spark.createDataFrame(rows, "g int, volumen double, x array<double>")


def test_grouped_kmeans_equals_each_group_alone(spark):
    r = random.Random(3)
    rows = [(g, float(v), [v + r.random(), r.random() * 5]) for g in (1, 2, 3) for v in [r.choice([0, 10, 20, 40]) for _ in range(40)]]
    rows.append((None, 1.0, [1.0, 1.0]))
    both, centers = V.grouped_kmeans(_points(spark, rows), "g", 4, 20, 2)
    assert both.count() == 120
    for g in (1, 2, 3):
        _, alone = V.grouped_kmeans(_points(spark, [x for x in rows if x[0] == g]), "g", 4, 20, 2)
        assert alone == {k: c for k, c in centers.items() if k[0] == g}
    # every point is with its nearest centre and every centre is its points' mean
    mean = {}
    for p in both.collect():
        d = {j: sum((a - b) ** 2 for a, b in zip(p.x, c)) for (g, j), c in centers.items() if g == p.g}
        assert d[p.cluster] <= min(d.values()) + 1e-9
        mean.setdefault((p.g, p.cluster), []).append(p.x)
    for key, xs in mean.items():
        assert all(abs(sum(x[i] for x in xs) / len(xs) - centers[key][i]) < 1e-6 for i in range(2))


def test_one_value_one_cluster_and_empty(spark):
    same, centers = V.grouped_kmeans(_points(spark, [(1, 5.0, [1.0, 2.0])] * 6), "g", 4, 20, 2)
    assert len(centers) == 1 and same.select("cluster").distinct().count() == 1
    none, centers = V.grouped_kmeans(_points(spark, []), "g", 4, 20, 2)
    assert centers == {} and none.count() == 0


def test_transitions_add_up(spark):
    rows = [("a", 2000, 0), ("b", 2000, 0), ("c", 2000, 1), (None, 2000, 1), ("a", 2001, 0), ("b", 2001, 1), (None, 2001, 1), ("d", 2001, 0),
            ("a", 2003, 1)]
    members = spark.createDataFrame(rows, "k string, anio int, trayectoria int")
    got = {tuple(r) for r in V.track_transitions(members, ["k"]).collect()}
    assert got == {(2000, 0, 0, 1, 50.0), (2000, 0, 1, 1, 50.0), (2000, 1, 1, 1, 100.0)}


def test_query_on_the_test_tables(spark):
    members, tracks = registry.evolution(spark, SF_SMALL)
    assert tracks.groupBy("anio").agg(F.countDistinct("trayectoria").alias("n"), F.count("*").alias("c")).where("n <> c").count() == 0
    checks = {r.control: r.valor for r in V.evolution_checks(members, tracks).collect()}
    assert checks["lejos_de_su_centro"] == checks["filas_sin_100"] == checks["emparejamientos_superados"] == 0
