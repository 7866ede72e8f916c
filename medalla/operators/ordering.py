"""Distributed global order: row numbers, running totals, exact quantiles.

``row_number() OVER (ORDER BY ...)`` without PARTITION BY makes Spark move
every row into one task. Here the order is computed in parallel, in the same
way at every size:

1. the input (an aggregate, small next to the raw data) is written once, so
   the range sampler and the numbering read it instead of recomputing the
   upstream plan;
2. rows are range-partitioned and sorted on the full order (the order ends
   with unique keys, so a run of equal metric values is split as well);
   ``monotonically_increasing_id`` puts the partition in the upper bits and
   the position in the lower 33. The numbered table is written, so the
   numbering is fixed once and survives the loss of an executor;
3. counts (and sums) per partition become start offsets: a table of one row
   per range partition, the only thing that is ever ordered in one task;
4. index = offset + position.

No join is forced to broadcast: Spark's byte estimates and AQE decide.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalla.session import ensure_checkpoint_dir, materialize, shuffle_partitions

_LOW_BITS = (1 << 33) - 1

#: accuracy of the quantile sketch: brackets hold about 8 / SKETCH of the rows
SKETCH = 20_000


def _as_order(cols: Sequence) -> list[Column]:
    return [F.col(c).asc() if isinstance(c, str) else c for c in cols]


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL; the keys come once, from the
    left."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys])
    return left.join(other, cond, how).drop(*[f"_r_{k}" for k in keys])


def _numbered(df: DataFrame, order: Sequence, partitions: int | None, materialized: bool) -> DataFrame:
    """``df`` with ``_part`` and ``_pos`` (position in the range partition)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    ordr = _as_order(order)
    src = df if materialized else materialize(df, "rank-input")
    n = partitions or shuffle_partitions(spark)
    numbered = (src.repartitionByRange(n, *ordr).sortWithinPartitions(*ordr)
                .withColumn("_mid", F.monotonically_increasing_id()))
    numbered = materialize(numbered, "rank-numbered")
    return numbered.withColumns({"_part": F.shiftright("_mid", 33),
                                 "_pos": F.col("_mid").bitwiseAND(F.lit(_LOW_BITS))}).drop("_mid")


def _offset(col: str) -> Column:
    """Sum over the partitions before: over one row per range partition."""
    return F.coalesce(F.sum(col).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def ordered_index(df: DataFrame, order: Sequence, index_col: str = "_ix",
                  partitions: int | None = None, materialized: bool = False) -> DataFrame:
    """``df`` with a 0-based global position (bigint) under ``order`` (a total
    order is expected; ties get an arbitrary but fixed order). Pass
    ``materialized=True`` when ``df`` is a written table."""
    numbered = _numbered(df, order, partitions, materialized)
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", _offset("_n").alias("_off"))
    return (numbered.join(offsets, "_part").withColumn(index_col, F.col("_off") + F.col("_pos"))
            .drop("_part", "_pos", "_off"))


def running_total(df: DataFrame, value: str, order: Sequence, out: str = "acumulado",
                  index_col: str = "posicion") -> DataFrame:
    """Running sum of ``value`` and 1-based position in a global order: the
    running sum inside a range partition plus the sum of those before it."""
    numbered = _numbered(df, order, None, False)
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_s"))
    offsets = sizes.select("_part", _offset("_n").alias("_off"), _offset("_s").alias("_sum"))
    inner = F.sum(value).over(Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0))
    return (numbered.join(offsets, "_part")
            .withColumns({out: F.col("_sum") + inner, index_col: F.col("_off") + F.col("_pos") + 1})
            .drop("_part", "_pos", "_off", "_sum"))


def step_up(df: DataFrame, p: str, keys: Sequence[str], out: str = "q", materialized: bool = False) -> DataFrame:
    """``df`` with the p-values ``p`` adjusted by Benjamini and Hochberg:
    the least of p * m / rank over a value and all larger ones, at most 1, m
    being the number of values. From the largest p downwards this is a
    running minimum: the one inside a range partition, and the minima of
    the partitions before. Rows without a p-value are not counted and get
    none."""
    numbered = _numbered(df, [F.col(p).desc_nulls_last(), *keys], None, materialized)
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    total = numbered.agg(F.count(p)).scalar()
    placed = numbered.join(sizes.select("_part", _offset("_n").alias("_off")), "_part")
    placed = placed.withColumn("_v", F.when(F.col(p).isNotNull(), F.least(
        F.lit(1.0), F.col(p) * total / (total - F.col("_off") - F.col("_pos")))))
    least = placed.groupBy("_part").agg(F.min("_v").alias("_least"))
    least = least.select("_part", F.min("_least").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"))
    inner = F.min("_v").over(Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0))
    return (placed.withColumn("_inner", inner).join(least, "_part")
            .withColumn(out, F.when(F.col(p).isNotNull(), F.least("_inner", "_before")))
            .drop("_part", "_pos", "_off", "_v", "_inner", "_before"))


def global_rank(df: DataFrame, order: Sequence, rank_col: str,
                partition_by: Sequence[str] = (), materialized: bool = False) -> DataFrame:
    """``row_number() OVER ([PARTITION BY p] ORDER BY order)`` as a bigint,
    without a single-task window.

    With ``partition_by`` the global index runs over (p, order); a group's
    rank is its index minus the group's first index (one row per group,
    joined back on the group; NULL is a group like any other).
    """
    part = list(partition_by)
    full = [F.col(p).asc() for p in part] + _as_order(order)
    ix = ordered_index(df, full, "_gix", materialized=materialized)
    if not part:
        return ix.withColumn(rank_col, F.col("_gix") + 1).drop("_gix")
    starts = ix.groupBy(*part).agg(F.min("_gix").alias("_g0"))
    return (null_safe(ix, starts, part).withColumn(rank_col, F.col("_gix") - F.col("_g0") + 1)
            .drop("_gix", "_g0"))


def exact_quantiles(df: DataFrame, group_col: str, value_col: str, probs: Sequence[float]) -> DataFrame:
    """Exact linear-interpolation quantiles of ``value_col`` per group
    (numpy/pandas default, DuckDB ``quantile_cont``): (group_col, p, value).

    A few narrow passes over the rows instead of a global sort. A quantile
    sketch gives each wanted position a bracket of values that surely holds
    it (its rank error is bounded); further passes count the rows below
    each bracket and gather the distinct values inside, some 8 / SKETCH of
    the rows; only those are ordered. The counts prove each bracket: one that
    fails is replaced by the group's whole range and counted again. NULL
    values are left out; NULL is a group like any other.
    """
    probs = [float(p) for p in probs]
    base = (df.select(F.col(group_col).alias("_g"), F.col(value_col).cast("double").alias("_v"))
            .filter(F.col("_v").isNotNull()))
    slack = 4.0 / SKETCH
    asked = sorted({min(1.0, max(0.0, p + s)) for p in probs for s in (-slack, slack)})
    seen = base.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
                                  F.percentile_approx("_v", asked, SKETCH).alias("_q"))
    h = (F.col("_n") - 1) * F.col("p")
    wanted = seen.select("_g", "_min", "_max", "_n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("j"), F.lit(p).alias("p"),
                 (F.col("_min") if p - slack <= 0 else F.col("_q")[asked.index(p - slack)]).alias("lo"),
                 (F.col("_max") if p + slack >= 1 else F.col("_q")[asked.index(p + slack)]).alias("hi"))
        for i, p in enumerate(probs)])).alias("b")).select("_g", "_min", "_max", "_n", "b.*")
    wanted = materialize(wanted.select("_g", "j", "p", "lo", "hi", "_min", "_max", F.floor(h).cast("long").alias("_from"),
                                       F.ceil(h).cast("long").alias("_to"), (h - F.floor(h)).alias("_frac")),
                         "quantile-brackets")

    def count(brackets: DataFrame) -> DataFrame:
        """Distinct values in each bracket with their rows; NULL stands for
        all rows below the bracket. One wide aggregate counts those; only
        rows inside a bracket are taken out one by one."""
        every = range(len(probs))
        per = brackets.groupBy("_g").agg(*(F.max(F.when(F.col("j") == i, F.col(c))).alias(f"{c}{i}") for i in every for c in ("lo", "hi")))
        rows = null_safe(base, per, ["_g"])
        below = rows.groupBy("_g").agg(*(F.count(F.when(F.col("_v") < F.col(f"lo{i}"), 1)).alias(f"c{i}") for i in every))
        below = below.select("_g", F.inline(F.array(*(F.struct(
            F.lit(i).alias("j"), F.lit(None).cast("double").alias("_v"), F.col(f"c{i}").alias("_c")) for i in every))))
        inside = [F.col("_v").between(F.col(f"lo{i}"), F.col(f"hi{i}")) for i in every]
        hit = rows.where(reduce(Column.__or__, inside)).select(
            "_g", "_v", F.explode(F.array_compact(F.array(*(F.when(x, F.lit(i)) for i, x in enumerate(inside))))).alias("j"))
        hit = hit.groupBy("_g", "j", "_v").agg(F.count(F.lit(1)).alias("_c"))
        return hit.unionByName(below.where("_c > 0"))

    def spans(brackets: DataFrame) -> DataFrame:
        before = F.sum("_c").over(Window.partitionBy("_g", "j").orderBy(F.col("_v").asc_nulls_first())
                                  .rowsBetween(Window.unboundedPreceding, 0))
        return materialize(count(brackets).withColumn("_end", before), "quantile-spans")

    def proven(brackets: DataFrame, found: DataFrame) -> DataFrame:
        ends = found.groupBy("_g", "j").agg(F.sum("_c").alias("_all"),
                                            F.coalesce(F.sum(F.when(F.col("_v").isNull(), F.col("_c"))), F.lit(0)).alias("_below"))
        return null_safe(brackets, ends, ["_g", "j"], "left").withColumn(
            "_ok", F.coalesce((F.col("_below") <= F.col("_from")) & (F.col("_to") < F.col("_all")), F.lit(False)))

    found = spans(wanted)
    checked = materialize(proven(wanted, found).select(*wanted.columns, "_ok"), "quantile-proof")
    if checked.where(~F.col("_ok")).limit(1).count():  # not seen within the sketch's bound
        wide = checked.where(~F.col("_ok")).withColumns({"lo": F.col("_min"), "hi": F.col("_max")}).drop("_ok")
        good = checked.where("_ok").select(F.col("_g"), "j")
        found = null_safe(found, good, ["_g", "j"]).unionByName(spans(wide))
    at = null_safe(found.where("_v is not null"), wanted.select("_g", "j", "p", "_from", "_to", "_frac"), ["_g", "j"])
    start = F.col("_end") - F.col("_c")

    def value(pos: str) -> Column:
        return F.max(F.when((F.col(pos) >= start) & (F.col(pos) < F.col("_end")), F.col("_v")))

    got = at.groupBy("_g", "j", "p", "_frac").agg(value("_from").alias("_a"), value("_to").alias("_b"))
    return got.select(F.col("_g").alias(group_col), "p",
                      (F.col("_a") + F.col("_frac") * (F.col("_b") - F.col("_a"))).alias("value"))
