"""Nearest peers: the k closest entities of every entity, exactly, by cells
around pivots whose distances bound what has to be compared."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalla.operators.segment import entity_features, standardize
from medalla.schema import ENTITY_FEATURES, ENTITY_KEYS
from medalla.session import materialize

#: pivots, the rows of lowest hash: they decide what is skipped, nothing else
PIVOTS = 32
#: rows of a block that is compared with another
BLOCK = 1024
#: what rounding may take from a bound
SLACK = 1e-9


def _distance(x: Column, pivot: Sequence[float]) -> Column:
    return F.sqrt(sum((x[i] - F.lit(float(v))) * (x[i] - F.lit(float(v))) for i, v in enumerate(pivot)))


def _reach(cells: list, pivots: np.ndarray, k: int) -> dict[int, float]:
    """For each cell a radius that surely holds the k nearest others of any of
    its rows: the cells nearest to it by their farthest rows, until they have
    k rows besides the row itself."""
    out = {}
    for c in cells:
        far = sorted((float(np.linalg.norm(pivots[c.cell] - pivots[o.cell])) + c.radius + o.radius, o.n) for o in cells)
        have = np.cumsum([n for _, n in far])
        enough = np.flatnonzero(have >= k + 1)
        out[c.cell] = far[enough[0]][0] if len(enough) else far[-1][0]
    return out


def nearest(points: DataFrame, keys: Sequence[str], features: Sequence[str], k: int = 5, pivots: int = PIVOTS,
            block: int = BLOCK) -> DataFrame:
    """``keys``, ``vecino_<key>``, ``posicion`` (from 1) and ``distancia``:
    the ``k`` other rows of ``points`` closest to each in Euclidean distance
    over ``features``, ties by the keys (NULL first); fewer if there are no more rows.

    Each row belongs to the cell of its nearest pivot. Counts and radii of
    the cells (one row each) bound how far the k nearest of a cell's rows can
    lie; a row goes to the cells within whose bound it may be. Cells meet
    these candidates in blocks of ``block`` rows, whatever their size; only
    the k nearest of a block leave it. Rows with a NULL or NaN feature have
    no neighbours and are none. Keys that occur twice are two rows.
    """
    keys, features = list(keys), list(features)
    usable = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in features]
    rows = points
    for u in usable:
        rows = rows.where(u)
    rows = rows.select(F.struct(*keys).alias("key"), F.array(*(F.col(c).cast("double") for c in features)).alias("x"))
    rows = materialize(rows.withColumn("id", F.monotonically_increasing_id()), "peers-rows")
    centre = np.array([r.x for r in rows.orderBy(F.xxhash64("x"), "id").limit(pivots).select("x").collect()])
    names = [T.StructField(f"vecino_{c}", points.schema[c].dataType) for c in keys]
    if not len(centre):
        fields = [*(T.StructField(c, points.schema[c].dataType) for c in keys), *names,
                  T.StructField("posicion", T.IntegerType()), T.StructField("distancia", T.DoubleType())]
        return points.sparkSession.createDataFrame([], T.StructType(fields))
    away = F.array(*(_distance(F.col("x"), p) for p in centre))
    placed = rows.withColumn("away", away).withColumn("cell", (F.array_position("away", F.array_min("away")) - 1).cast("int"))
    placed = materialize(placed, "peers-cells")
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max(F.array_min("away")).alias("radius")).collect()
    reach, size = _reach(cells, centre, k), {c.cell: c.n for c in cells}
    radius = {c.cell: c.radius for c in cells}
    # the cells a row may be near to: at most one per pivot
    near = F.array_compact(F.array(*(F.when(F.col("away")[c] - radius[c] <= reach[c] + SLACK, F.lit(c)) for c in sorted(size))))
    cand = placed.select("id", "key", "x", F.explode(near).alias("cell"))
    counts = {r.cell: r.n for r in cand.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}

    def blocks(n: dict[int, int]) -> Column:
        return F.array(*(F.lit(max(1, -(-n.get(c, 0) // block))) for c in range(len(centre))))[F.col("cell")]

    def dealt(df: DataFrame, own: dict[int, int], others: dict[int, int], mine: str, other: str, side: int) -> DataFrame:
        return df.select("id", "key", "x", "cell", F.pmod(F.xxhash64("id"), blocks(own)).cast("int").alias(mine),
                         F.explode(F.sequence(F.lit(0), blocks(others) - 1)).alias(other), F.lit(side).alias("side"))

    pairs = dealt(placed, size, counts, "i", "j", 0).unionByName(dealt(cand, counts, size, "j", "i", 1))

    def closest(g: pd.DataFrame) -> pd.DataFrame:
        a, b = g[g.side == 0], g[g.side == 1]
        out = {"id": [], "other": [], "distancia": []}
        if len(a) and len(b):
            y, yid = np.stack(b.x), b.id.to_numpy()
            for aid, x in zip(a.id.to_numpy(), a.x):
                d = np.zeros(len(y))
                for f in range(y.shape[1]):
                    d += (y[:, f] - x[f]) ** 2
                d[yid == aid] = np.inf
                # ties of the k-th stay: the keys decide later
                limit = np.partition(d, min(k, len(d)) - 1)[min(k, len(d)) - 1]
                hit = np.flatnonzero((d <= limit) & np.isfinite(d))
                tied = hit[d[hit] == limit]
                if len(tied) > k:  # the smallest keys of a tie are enough
                    first = sorted(tied, key=lambda t: [(v is not None and v == v, v) for v in b.key.iloc[t].values()])[:k]
                    hit = np.concatenate([hit[d[hit] < limit], first]).astype(int)
                out["id"] += [aid] * len(hit)
                out["other"] += yid[hit].tolist()
                out["distancia"] += np.sqrt(d[hit]).tolist()
        return pd.DataFrame(out).astype({"id": "int64", "other": "int64", "distancia": "float64"})

    found = pairs.groupBy("cell", "i", "j").applyInPandas(closest, "id long, other long, distancia double")
    found = found.join(rows.select(F.col("id").alias("other_id"), F.col("key").alias("key2")), F.col("other") == F.col("other_id"))
    found = found.select("id", "distancia", F.col("key2").alias("other"))
    rank = Window.partitionBy("id").orderBy("distancia", *(F.col(f"other.{c}").asc_nulls_first() for c in keys))
    best = found.withColumn("posicion", F.row_number().over(rank)).where(F.col("posicion") <= k)
    return best.join(rows.select("id", "key"), "id").select(
        *(F.col(f"key.{c}").alias(c) for c in keys), *(F.col(f"other.{c}").alias(f"vecino_{c}") for c in keys),
        "posicion", F.round("distancia", 6).alias("distancia"))


def nearest_peers(entity: DataFrame, k: int = 5, keys: Sequence[str] = ENTITY_KEYS,
                  features: Sequence[str] = ENTITY_FEATURES) -> DataFrame:
    """The ``k`` entities most like each, by its standardised features."""
    z = standardize(entity_features(entity, keys, features), features, keep=keys)
    return nearest(z, keys, [f"{c}_z" for c in features], k)
