"""Clusters followed over time: one K-Means per year, matched from year to
year, and the moves of entities between the matched clusters.

All years are clustered at once: an iteration is one aggregate over the
entity-years, whatever the number of years, and only the centres (k rows per
year) come to the driver, as in any K-Means. Seeds are the feature means of
equal-count volume bands, so the same data always give the same clusters.
Centres of consecutive years are matched one to one at the least total squared
distance (assignment problem, solved exactly), which gives every cluster a
track over the years.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalla.operators.ordering import exact_quantiles, null_safe
from medalla.operators.segment import standardize, yearly_features
from medalla.schema import ENTITY_FEATURES, ENTITY_KEYS
from medalla.session import materialize

#: decimals of a centre: sums of doubles differ in the last places with the
#: order of rows, which must not move a cluster
CENTER_SCALE = 9


def yearly_points(silver: DataFrame, keys: Sequence[str] = ENTITY_KEYS, year: str = "anio",
                  features: Sequence[str] = ENTITY_FEATURES) -> DataFrame:
    """Entity-years with their volume and ``x``, the features standardised
    over all years, so that centres of different years compare."""
    rows = materialize(yearly_features(silver, keys, year).na.drop(subset=list(features)), "yearly-features")
    z = standardize(rows, features, "_z", keep=[*keys, year, features[0]], scale=None)
    return materialize(z.select(*keys, year, F.col(features[0]).alias("volumen"),
                                F.array(*[F.col(f"{c}_z") for c in features]).alias("x")), "yearly-points")


def _distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, d: s + d)


def _centers(points: DataFrame, group: str, cluster: str, width: int) -> dict[tuple, tuple]:
    """Mean of ``x`` per (group, cluster): k rows per group."""
    rows = points.groupBy(group, cluster).agg(*[F.round(F.avg(F.col("x")[i]), CENTER_SCALE).alias(f"c{i}") for i in range(width)])
    return {(r[0], r[1]): tuple(r[2:]) for r in rows.collect()}


def _nearest(points: DataFrame, centers: dict[tuple, tuple], group: str, out: str) -> DataFrame:
    per: dict = {}
    for (g, j), c in sorted(centers.items()):
        per.setdefault(g, []).append((j, list(c)))
    table = points.sparkSession.createDataFrame(  # k entries per group
        sorted(per.items()), f"{group} {dict(points.dtypes)[group]}, _cs array<struct<j:int,c:array<double>>>")
    pick = F.array_min(F.transform("_cs", lambda c: F.struct(_distance(F.col("x"), c["c"]).alias("d"), c["j"].alias("j"))))
    return points.join(F.broadcast(table), group).withColumn(out, pick["j"]).drop("_cs")


def grouped_kmeans(points: DataFrame, group: str, k: int = 4, max_iter: int = 20, width: int = len(ENTITY_FEATURES),
                   out: str = "cluster") -> tuple[DataFrame, dict[tuple, tuple]]:
    """Lloyd's K-Means inside every ``group`` of ``points(group, volumen, x)``
    at once. Returns the points with ``out`` (0 .. k-1; seeded by ascending
    volume) and the centres by (group, cluster). A group whose volumes do not
    make k bands has fewer clusters; a cluster that loses all its points keeps
    its centre. Rows without a group are left out."""
    points = points.where(F.col(group).isNotNull())
    bounds = exact_quantiles(points, group, "volumen", [j / k for j in range(1, k)])
    bounds = bounds.groupBy(group).agg(F.collect_list("value").alias("_b"))  # k - 1 per group
    band = F.size(F.filter("_b", lambda b: b < F.col("volumen").cast("double")))
    centers = _centers(points.join(bounds, group).withColumn("_band", band), group, "_band", width)
    for _ in range(max_iter):
        moved = centers | _centers(_nearest(points, centers, group, out), group, out, width)
        if moved == centers:
            break
        centers = moved
    return _nearest(points, centers, group, out), centers


def assignment(cost: Sequence[Sequence[float]]) -> list[int]:
    """The column of each row (-1: none) in a one-to-one matching of least
    total cost: shortest augmenting paths with potentials. The matrix may have
    more rows than columns or the other way round."""
    rows, cols = len(cost), len(cost[0]) if cost else 0
    n = max(rows, cols)
    square = [[cost[i][j] if i < rows and j < cols else 0.0 for j in range(n)] for i in range(n)]
    of_col, u, v = [-1] * n, [0.0] * n, [0.0] * n
    for start in range(n):
        slack, via, done = [float("inf")] * n, [-1] * n, [False] * n
        row, last = start, -1
        while True:
            best = -1
            for j in range(n):
                if done[j]:
                    continue
                d = square[row][j] - u[row] - v[j]
                if d < slack[j]:
                    slack[j], via[j] = d, last
                if best < 0 or slack[j] < slack[best]:
                    best = j
            step = slack[best]
            u[start] += step
            for j in range(n):
                if done[j]:
                    u[of_col[j]] += step
                    v[j] -= step
                else:
                    slack[j] -= step
            done[best] = True
            last = best
            if of_col[best] < 0:
                break
            row = of_col[best]
        while last >= 0:  # turn the path round
            prev = via[last]
            of_col[last] = of_col[prev] if prev >= 0 else start
            last = prev
    out = [-1] * rows
    for j, i in enumerate(of_col):
        if i < rows and j < cols:
            out[i] = j
    return out


def match_centers(centers: dict[tuple, tuple]) -> list[tuple]:
    """``(group, cluster, track, cost)`` from the centres by (group, cluster):
    a cluster matched to one of the group before takes its track, at the
    squared distance ``cost``; others begin a track. Centres only, k a group."""
    groups: dict = {}
    for (g, j), c in sorted(centers.items()):
        groups.setdefault(g, []).append((j, c))
    out: list[tuple] = []
    before: list[tuple] = []  # (track, centre)
    fresh = 0
    for g in sorted(groups):
        here = groups[g]
        cost = [[sum((p - q) ** 2 for p, q in zip(c, old)) for _, c in here] for _, old in before]
        match = {j: i for i, j in enumerate(assignment(cost)) if j >= 0} if cost else {}
        now = []
        for at, (j, c) in enumerate(here):
            if at in match:
                track, paid = before[match[at]][0], cost[match[at]][at]
            else:
                track, paid, fresh = fresh, None, fresh + 1
            now.append((track, c))
            out.append((g, j, track, paid))
        before = now
    return out


def cluster_evolution(silver: DataFrame, k: int = 4, max_iter: int = 20, keys: Sequence[str] = ENTITY_KEYS, year: str = "anio",
                      features: Sequence[str] = ENTITY_FEATURES) -> tuple[DataFrame, DataFrame]:
    """Entity-years with their ``cluster`` and ``trayectoria`` (the track), and
    the tracks: ``(year, cluster, trayectoria, distancia, centro)``, distance
    to the matched centre of the year before (null where a track begins)."""
    spark = silver.sparkSession
    points, centers = grouped_kmeans(yearly_points(silver, keys, year, features), year, k, max_iter, len(features))
    kind = dict(points.dtypes)[year]
    rows = [(g, j, t, None if d is None else d ** 0.5, list(centers[g, j])) for g, j, t, d in match_centers(centers)]
    tracks = spark.createDataFrame(rows, f"{year} {kind}, cluster int, trayectoria int, distancia double, centro array<double>")
    slim = F.broadcast(tracks.select(year, "cluster", "trayectoria"))  # k rows a year
    return materialize(points.join(slim, [year, "cluster"]), "cluster-years"), tracks


def track_profile(members: DataFrame, tracks: DataFrame, year: str = "anio") -> DataFrame:
    """Per year and track: entities, their complaints, and how far the centre
    has moved since the year before."""
    sizes = members.groupBy(year, "trayectoria").agg(F.count(F.lit(1)).alias("entidades"), F.sum("volumen").alias("quejas"))
    return tracks.select(year, "trayectoria", F.round("distancia", 6).alias("distancia")).join(sizes, [year, "trayectoria"])


def track_transitions(members: DataFrame, keys: Sequence[str] = ENTITY_KEYS, year: str = "anio") -> DataFrame:
    """Entities present in two consecutive years by the track they were in and
    the one they are in: ``(anio_origen, origen, destino, entidades,
    porcentaje)``, the share of those that were in ``origen``. A NULL key is a
    key like any other."""
    a = members.select(*keys, (F.col(year) + 1).alias(year), F.col("trayectoria").alias("origen"))
    b = members.select(*keys, year, F.col("trayectoria").alias("destino"))
    moves = materialize(null_safe(a, b, [*keys, year]).groupBy((F.col(year) - 1).cast("int").alias("anio_origen"), "origen", "destino")
                        .agg(F.count(F.lit(1)).alias("entidades")), "track-moves")
    left = moves.groupBy("anio_origen", "origen").agg(F.sum("entidades").alias("_n"))
    return moves.join(left, ["anio_origen", "origen"]).select(
        "anio_origen", "origen", "destino", "entidades", F.round(F.col("entidades") * 100.0 / F.col("_n"), 4).alias("porcentaje"))


def evolution_checks(members: DataFrame, tracks: DataFrame, keys: Sequence[str] = ENTITY_KEYS, year: str = "anio") -> DataFrame:
    """Facts that any right answer has, as (control, valor): entity-years,
    entities in two consecutive years by the transitions, members nearer to
    another centre of their year, transition rows that do not add up to 100 %,
    and pairs of years whose matching some other order of the clusters would
    beat (all orders are tried: small k)."""
    moves = track_transitions(members, keys, year)
    per = tracks.groupBy(year).agg(F.collect_list("centro").alias("_all"))  # k entries
    own = tracks.select(year, "cluster", "centro")
    far = members.join(F.broadcast(own), [year, "cluster"]).join(F.broadcast(per), year).select((F.array_min(F.transform(
        "_all", lambda c: _distance(F.col("x"), c))) < _distance(F.col("x"), F.col("centro")) - 1e-9).cast("long").alias("v"))
    odd = moves.groupBy("anio_origen", "origen").agg(F.sum("porcentaje").alias("p")).select((F.abs(F.col("p") - 100) > 0.01).cast("long").alias("v"))

    def beaten(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        now, then = (g[g["when"] == w].sort_values("cluster") for w in (0, 1))
        cost = [[sum((p - q) ** 2 for p, q in zip(a, b)) for b in now.centro] for a in then.centro]
        if len(then) > len(now):
            cost = [list(r) for r in zip(*cost)]
        least = min((sum(cost[i][j] for i, j in enumerate(order)) for order in permutations(range(len(cost[0]) if cost else 0), len(cost))),
                    default=0.0)
        return pd.DataFrame({"v": [int((now.distancia.dropna() ** 2).sum() > least + 1e-6)]})

    both = tracks.withColumn("when", F.lit(0)).unionByName(tracks.withColumns({year: F.col(year) + 1, "when": F.lit(1)}).join(
        tracks.select(year).distinct(), year, "left_semi"))
    parts = {
        "entidades_anio": members.agg(F.count(F.lit(1)).alias("v")),
        "entidades_en_ambos_anios": moves.agg(F.coalesce(F.sum("entidades"), F.lit(0)).alias("v")),
        "lejos_de_su_centro": far.agg(F.coalesce(F.sum("v"), F.lit(0)).alias("v")),
        "filas_sin_100": odd.agg(F.coalesce(F.sum("v"), F.lit(0)).alias("v")),
        "emparejamientos_superados": both.groupBy(year).applyInPandas(beaten, "v long").agg(F.coalesce(F.sum("v"), F.lit(0)).alias("v")),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("control"), F.col("v").cast("bigint").alias("valor"))
                                          for name, df in parts.items()])
