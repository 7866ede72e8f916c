"""Entity rankings: three measures, one scan, one distributed rank.

The three rankings (total complaints, distinct products, complaints in the
most recent year) come from ONE aggregate per entity; ``stack`` turns each
entity row into (ranking_tipo, value) rows and one rank partitioned by
ranking type numbers all three in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalla.operators.marts import row_count
from medalla.operators.ordering import global_rank
from medalla.schema import RANK_PRODUCTS, RANK_RECENT_PREFIX, RANK_TOTAL, RANKING_KEYS


def rankings(silver: DataFrame, recent_year: int | None = None, keys: Sequence[str] = RANKING_KEYS,
             product: str = "producto", year: str = "anio", weight: str | None = None) -> DataFrame:
    """(nombre_entidad, tipo_entidad_desc, total_quejas, ranking_tipo, posicion).

    ``recent_year`` defaults to the latest year in the data (a scalar
    subquery, not a driver round trip). Entities with no
    complaint that year are absent from that ranking. The column
    ``total_quejas`` holds the ranked value (for the product ranking, the
    distinct product count)."""
    keys = list(keys)
    # one pass over silver: (entity, year, product) counts; every measure
    # and the latest year are computed from this much smaller table
    cube = silver.groupBy(*keys, year, product).agg(row_count(weight).alias("_n"))
    ry = cube.agg(F.max(year)).scalar() if recent_year is None else F.lit(recent_year).cast("int")
    per = (cube.withColumn("_ry", ry)
               .groupBy(*keys).agg(
                   F.sum("_n").alias("_total"),
                   F.countDistinct(product).alias("_products"),
                   F.sum(F.when(F.col(year) == F.col("_ry"), F.col("_n")).otherwise(F.lit(0))).alias("_recent"),
                   F.max("_ry").alias("_ry")))
    recent_tag = F.concat(F.lit(RANK_RECENT_PREFIX), F.col("_ry").cast("string"))
    stacked = per.select(*keys, F.inline(F.array(
        F.struct(F.lit(RANK_TOTAL).alias("ranking_tipo"), F.col("_total").alias("total_quejas")),
        F.struct(F.lit(RANK_PRODUCTS).alias("ranking_tipo"), F.col("_products").alias("total_quejas")),
        F.struct(recent_tag.alias("ranking_tipo"), F.col("_recent").alias("total_quejas")),
    )))
    stacked = stacked.filter(~(F.col("ranking_tipo").startswith(RANK_RECENT_PREFIX)
                               & (F.col("total_quejas") == 0)))
    order = [F.col("total_quejas").desc()] + [F.col(k).asc() for k in keys]
    ranked = global_rank(stacked, order, "posicion", partition_by=["ranking_tipo"])
    return ranked.select(*keys, "total_quejas", "ranking_tipo", "posicion")


def top_per_ranking(ranked: DataFrame, n: int = 10) -> DataFrame:
    """The first n of every ranking type at once."""
    return ranked.filter(F.col("posicion") <= n)
