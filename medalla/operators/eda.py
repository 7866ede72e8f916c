"""Exploratory statistics: describe, exact percentiles, histogram, correlations.

The numbers a notebook gets from ``toPandas().describe()`` and a plotted
histogram are computed here as distributed aggregates; charts are left to
whoever reads the (small) results.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalla.operators.ordering import exact_quantiles
from medalla.schema import ENTITY_FEATURES


def to_long(df: DataFrame, columns: Sequence[str], name_col: str = "metrica",
            value_col: str = "valor") -> DataFrame:
    """(metric, value) rows, values as double."""
    return df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias(name_col), F.col(c).cast("double").alias(value_col)) for c in columns])))


def describe_metrics(df: DataFrame, columns: Sequence[str] = ENTITY_FEATURES, scale: int | None = 6) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear), max per column:
    one row per column (floating results rounded to ``scale`` places, or not
    at all for None).

    Where every value is a decimal of at most ten places below 10^15, the mean
    is an exact decimal sum divided by the count: a double sum depends on the
    order rows are added in (so on the partitioning), and a mean of
    few-decimal data often lies exactly on a rounding boundary. Else (very
    large, very small or many-digit doubles, NaN, infinities) it is the mean
    of the doubles."""
    long = to_long(df, columns)
    exact = F.when(F.abs("valor") < 1e15, F.col("valor")).cast("decimal(38,10)")
    whole = F.count(F.when(exact.cast("double") == F.col("valor"), 1)) == F.count("valor")
    basic = long.groupBy("metrica").agg(
        F.count("valor").alias("conteo"),
        F.when(whole, (F.sum(exact) / F.count("valor")).cast("double")).otherwise(F.avg("valor")).alias("media"),
        F.stddev_samp("valor").alias("desviacion"), F.min("valor").alias("minimo"),
        F.max("valor").alias("maximo"))
    q = exact_quantiles(long, "metrica", "valor", (0.25, 0.5, 0.75))
    qw = q.groupBy("metrica").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("p25"),
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("p50"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("p75"))
    r = lambda c: F.col(c) if scale is None else F.round(c, scale).cast("double").alias(c)
    return basic.join(qw, "metrica", "left").select(
        "metrica", "conteo", r("media"), r("desviacion"), "minimo", r("p25"), r("p50"), r("p75"), "maximo")


def key_percentiles(df: DataFrame, columns: Sequence[str] = ("total_quejas", "promedio_quejas_por_mes"),
                    probs: Sequence[float] = (0.75, 0.90, 0.95), scale: int = 6) -> DataFrame:
    """(metrica, percentil, valor) exact linear percentiles."""
    q = exact_quantiles(to_long(df, columns), "metrica", "valor", probs)
    return q.select("metrica", F.col("p").alias("percentil"), F.round("value", scale).alias("valor"))


def histogram(df: DataFrame, column: str, bins: int = 50, scale: int = 6) -> DataFrame:
    """Equal-width histogram like numpy's: bins over [min, max], the last
    bin closed, min = max widened to +/- 0.5. All bins are returned, empty
    ones with 0, plus log10 of the count (NULL for 0). NaN and infinities
    take no part in the range; if there are any, a last row without a bin
    counts them.

    Two aggregates: (min, max) as a scalar subquery, then per-bin counts;
    both partial, and the output has ``bins`` rows."""
    every = F.col(column).cast("double")
    finite = F.abs(every) < float("inf")  # false for NaN: Spark orders it last
    v = F.when(finite, every)
    mn, mx = F.min(v), F.max(v)
    rng = df.agg(F.struct(F.when(mn == mx, mn - 0.5).otherwise(mn).alias("lo"),
                          F.when(mn == mx, mx + 0.5).otherwise(mx).alias("hi"))).scalar()
    lo, hi = rng.getField("lo"), rng.getField("hi")
    b = F.when(v.isNotNull(), F.least(F.floor((v - lo) * F.lit(bins) / (hi - lo)).cast("int"), F.lit(bins - 1)))
    counts = (df.select(column).filter(F.col(column).isNotNull())
                .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("frecuencia")))
    odd = counts.where("bin is null").select("bin", *[F.lit(None).cast("double").alias(c) for c in (
        "limite_inferior", "limite_superior")], "frecuencia")
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"),
                                              lo.alias("_lo"), hi.alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    out = grid.join(counts, "bin", "left").select(
        "bin",
        F.round(F.col("_lo") + F.col("bin") * w, scale).alias("limite_inferior"),
        F.round(F.when(F.col("bin") == bins - 1, F.col("_hi"))
                 .otherwise(F.col("_lo") + (F.col("bin") + 1) * w), scale).alias("limite_superior"),
        F.coalesce(F.col("frecuencia"), F.lit(0).cast("bigint")).alias("frecuencia")).unionByName(odd)
    return out.withColumn("log10_frecuencia", F.when(
        F.col("frecuencia") > 0, F.round(F.log10(F.col("frecuencia").cast("double")), scale)))


def correlations(df: DataFrame, columns: Sequence[str] = ENTITY_FEATURES, scale: int = 6) -> DataFrame:
    """Pearson correlation of every column pair, from one aggregate, as
    rows (variable_a, variable_b, correlacion). NULL where a column is
    constant (``corr`` itself raises a division by zero under ANSI)."""
    pairs = list(combinations(columns, 2))

    def pearson(a, b):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))

    one = df.agg(*[pearson(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("variable_a"), F.lit(b).alias("variable_b"),
                 F.round(F.col(f"c{i}"), scale).alias("correlacion"))
        for i, (a, b) in enumerate(pairs)])))
