"""What counts can bear: lift with shrinkage and a false discovery rate over
all cells, concentration with bootstrap bands."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalla.operators.ordering import _numbered, null_safe, step_up
from medalla.schema import ENTITY_KEYS
from medalla.session import materialize

#: fixed values: coefficients of the upper tail of the normal distribution
#: (Abramowitz and Stegun 26.2.17)
TAIL_SCALE = 0.2316419
TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
#: a 32-bit number at or above the k-th of these stands for a count above k
#: in a Poisson distribution of mean 1
POISSON_STEPS = [round(2**32 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(12)]


def normal_tail(x: Column) -> Column:
    """P(Z > x) of a standard normal Z, for x >= 0."""
    t = 1 / (1 + TAIL_SCALE * x)
    series = reduce(lambda s, b: (s + F.lit(b)) * t, reversed(TAIL), F.lit(0.0))
    return F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * series


def tested_lift(df: DataFrame, item: str = "motivo", group: str = "nombre_entidad", rate: float = 0.05) -> DataFrame:
    """Lift of every (item, group) that occurs, and how far it can be
    believed: ``quejas``, ``esperadas`` (under independence), ``lift``,
    ``lift_ajustado``, ``z``, ``p``, ``q``, ``significativo``.

    The adjusted lift is the mean of a Gamma prior of mean 1 after the
    Poisson count: (quejas + a) / (esperadas + a), 1 / a being the variance
    of the true ratios over all cells (by moments; none: every ratio is 1).
    ``z`` is the difference of the square roots, ``p`` its two-sided tail,
    ``q`` the smallest false discovery rate at which the cell is found
    (Benjamini and Hochberg, over all cells in one distributed order);
    ``significativo`` says whether it is at most ``rate``. NULL items and
    groups count as any other; an empty table gives no row.
    """
    c = materialize(df.groupBy(item, group).agg(F.count(F.lit(1)).alias("quejas")), "lift-counts")
    by_group, by_item = (c.groupBy(k).agg(F.sum("quejas").alias(n)) for k, n in ((group, "_g"), (item, "_i")))
    total = c.agg(F.sum("quejas")).scalar()
    cells = null_safe(null_safe(c, by_group, [group]), by_item, [item])
    cells = materialize(cells.select(item, group, "quejas", (F.col("_g") * 1.0 * F.col("_i") / total).alias("esperadas")), "lift-cells")
    n, e = F.col("quejas"), F.col("esperadas")
    spread = cells.agg(F.greatest(F.lit(0.0), F.sum((n - e) * (n - e) - e) / F.sum(e * e))).scalar()
    z = 2 * (F.sqrt(n) - F.sqrt(e))
    tested = cells.withColumns({"z": z, "p": F.least(F.lit(1.0), 2 * normal_tail(F.abs(z))),
                                "ajustado": (n * spread + 1) / (e * spread + 1)})
    return step_up(tested, "p", [item, group]).select(
        item, group, "quejas", F.round(e, 4).alias("esperadas"), F.round(n / e, 4).alias("lift"),
        F.round("ajustado", 4).alias("lift_ajustado"), F.round("z", 4).alias("z"), F.round("p", 6).alias("p"),
        F.round("q", 6).alias("q"), (F.col("q") <= rate).alias("significativo"))


def poisson_weight(key: Column, replicate: Column, seed: int) -> Column:
    """A Poisson(1) count that depends on key, replicate and seed only: the
    same in every task and after the loss of any."""
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), replicate, key)), 1, 8), 16, 10).cast("long")
    # bound by a lambda, the digest is taken once, not once a step
    return F.transform(F.array(u), lambda v: sum((F.when(v >= s, 1).otherwise(0) for s in POISSON_STEPS), F.lit(0)).cast("long"))[0]


def concentration_replicates(entity: DataFrame, value: str = "total_quejas", keys: Sequence[str] = ENTITY_KEYS,
                             replicates: int = 200, top_pct: int = 20, seed: int = 1) -> DataFrame:
    """``(replica, entidades, quejas, gini, participacion_top)`` of Poisson
    bootstrap samples of the entities, and of all of them as replicate 0.

    ``participacion_top`` is the percentage of ``value`` held by the largest
    ``top_pct`` % of the entities, one that straddles the limit in part.
    Entities are ordered once, by ``value`` and key, in ranges; a replicate's
    running sums are those inside a range plus the sums of the ranges before,
    so no replicate is gathered into one task. Rows without a value are left
    out; a replicate without entities or value has null shares.
    """
    keys = list(keys)
    order = [F.col("v").desc(), *(F.col(k).asc() for k in keys)]
    rows = _numbered(entity.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("long").alias("v")), order, None, False)
    text = F.concat_ws("|", *(F.col(k).cast("string") for k in keys))
    # behind the generator a weight is taken once, not once a reference
    drawn = F.transform(F.sequence(F.lit(0), F.lit(replicates)), lambda r: F.struct(r.alias("replica"), F.when(
        r == 0, F.lit(1).cast("long")).otherwise(poisson_weight(text, r, seed)).alias("w")))
    rows = rows.select("*", F.inline(drawn)).where("w > 0")
    held = F.col("w") * F.col("v")
    part = materialize(rows.groupBy("replica", "_part").agg(F.sum("w").alias("pw"), F.sum(held).alias("ps")), "bootstrap-parts")
    before = Window.partitionBy("replica").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("replica")  # one row a range
    part = part.select("replica", "_part", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("pw", "ps")),
                       F.sum("pw").over(every).alias("total_w"), F.sum("ps").over(every).alias("total_s"))
    inside = Window.partitionBy("replica", "_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"cw": F.sum("w").over(inside), "cs": F.sum(held).over(inside)}).join(part, ["replica", "_part"])
    cw, cs = F.col("pw_before") + F.col("cw"), F.col("ps_before") + F.col("cs")
    within = F.greatest(F.lit(0), F.least(100 * F.col("w"), top_pct * F.col("total_w") - 100 * (cw - F.col("w"))))
    out = rows.groupBy("replica").agg(
        F.first("total_w").alias("entidades"), F.first("total_s").alias("quejas"),
        F.sum(F.col("w") * (2.0 * cs - held)).alias("area"), F.sum(within * 1.0 * F.col("v")).alias("top"))
    return out.select("replica", "entidades", "quejas",
                      F.round(F.try_divide("area", F.col("entidades") * 1.0 * F.col("quejas")) - 1, 6).alias("gini"),
                      F.round(F.try_divide("top", F.col("quejas")), 6).alias("participacion_top"))


def concentration(replicas: DataFrame, band: float = 0.9) -> DataFrame:
    """One row: Gini coefficient and share of the largest entities, each with
    the middle ``band`` of its bootstrap replicates."""
    low, high = (1 - band) / 2, (1 + band) / 2
    own, drawn = F.col("replica") == 0, F.col("replica") > 0
    return replicas.agg(F.count(F.when(drawn, 1)).alias("replicas"), *(c for name in ("gini", "participacion_top") for c in (
        F.max(F.when(own, F.col(name))).alias(name),
        F.round(F.percentile(F.when(drawn, F.col(name)), low), 6).alias(f"{name}_inferior"),
        F.round(F.percentile(F.when(drawn, F.col(name)), high), 6).alias(f"{name}_superior"))))
