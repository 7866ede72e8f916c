"""The count cube: complaints per combination of every dimension the gold
tables use. One scan of silver makes it; the marts, rankings and KPIs read it
with its counts as weights, and cubes of separate loads add up.

Distinct counts over the cube are exact (a value occurs in the cube if and
only if it occurs in silver). Where a roll-up must not touch the cube again,
``distinct_sketches`` keeps one HyperLogLog sketch per fine group; sketches of
groups merge without recounting.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalla.operators import marts, ranking
from medalla.schema import ENTITY_KEYS, MONTH_KEYS

COUNT = "quejas"
DIMS = (*ENTITY_KEYS, "producto", "motivo", "estado", *MONTH_KEYS)
#: log2 of a sketch's registers: a standard error of about 1.04 / sqrt(2^12) = 1.6 %
LG_K = 12


def count_cube(silver: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """``dims`` and ``quejas``, one row per combination present (NULL is a
    value like any other). Partial counts leave each task once per
    combination, so a hot entity or product costs no more than others."""
    return silver.groupBy(*dims).agg(F.count(F.lit(1)).alias(COUNT))


def merge_cubes(cubes: Sequence[DataFrame], dims: Sequence[str] = DIMS) -> DataFrame:
    """The cube of all the rows that ``cubes`` were made of."""
    return reduce(DataFrame.unionByName, cubes).groupBy(*dims).agg(F.sum(COUNT).alias(COUNT))


def roll_up(cube: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The cube over fewer dimensions."""
    return cube.groupBy(*dims).agg(F.sum(COUNT).alias(COUNT))


def gold_tables(cube: DataFrame, stamp: bool = False) -> dict[str, Callable[[], DataFrame]]:
    """The five gold tables by name, each built from the cube when called."""
    return {
        "metricas_por_entidad": lambda: marts.entity_metrics(cube, weight=COUNT),
        "metricas_por_producto": lambda: marts.product_metrics(cube, weight=COUNT),
        "metricas_temporales": lambda: marts.monthly_metrics(cube, weight=COUNT),
        "ranking_entidades": lambda: ranking.rankings(cube, weight=COUNT),
        "dashboard_kpis": lambda: marts.kpi_table(cube, stamp=stamp, weight=COUNT),
    }


def distinct_sketches(cube: DataFrame, by: Sequence[str], columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """``by``, ``quejas`` and a HyperLogLog sketch of each of ``columns``
    (fixed size each). Distinct NULLs are not counted, as in SQL."""
    return cube.groupBy(*by).agg(F.sum(COUNT).alias(COUNT), *[
        F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"hll_{c}") for c in columns])


def merge_sketches(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Estimated distinct counts ``<column>_aprox`` over the coarser ``by``,
    from ``distinct_sketches`` alone."""
    return sketches.groupBy(*by).agg(F.sum(COUNT).alias(COUNT), *[
        F.hll_sketch_estimate(F.hll_union_agg(f"hll_{c}")).alias(f"{c}_aprox") for c in columns])
