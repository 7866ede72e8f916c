"""Time-series operators over a monthly (or any ordered) series.

A series has one row per period. Windows without ``partition_by`` therefore
run over one row per calendar month present - at most 12 per year of data -
which is a bounded single-partition window. With ``partition_by`` (one series
per entity, product, ...) each window partition is one such series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medalla.functions.scalar import trend_label
from medalla.operators.ordering import null_safe


def _w(order: str, partition_by: Sequence[str] = ()):
    w = Window.orderBy(F.col(order).asc())
    return w.partitionBy(*partition_by) if partition_by else w


def moving_average(df: DataFrame, value: str, order: str, n: int = 3, out: str | None = None,
                   partition_by: Sequence[str] = (), scale: int | None = 2) -> DataFrame:
    """Trailing mean over the last ``n`` present rows (the first rows use
    what is there)."""
    out = out or f"{value}_ma{n}"
    m = F.avg(value).over(_w(order, partition_by).rowsBetween(-(n - 1), 0))
    return df.withColumn(out, F.round(m, scale) if scale is not None else m)


def with_trend(df: DataFrame, value: str, order: str, out: str = "tendencia",
               partition_by: Sequence[str] = ()) -> DataFrame:
    """AUMENTO / DISMINUCION / ESTABLE against the previous row; the lag is
    computed once."""
    prev = F.lag(value, 1).over(_w(order, partition_by))
    return (df.withColumn("_prev", prev)
              .withColumn(out, trend_label(F.col(value), F.col("_prev")))
              .drop("_prev"))


def centered_moving_average(df: DataFrame, value: str, order: str, n: int = 12,
                            out: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Centred mean over ``n`` rows, NULL unless the frame is full (pandas
    ``rolling(n, center=True)``): frame i-n//2 .. i+(n-1)//2 for even n."""
    out = out or f"{value}_cma{n}"
    lo, hi = -(n // 2), (n - 1) // 2
    w = _w(order, partition_by).rowsBetween(lo, hi)
    return df.withColumn(out, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def yearly_series_stats(series: DataFrame, value: str = "total_quejas", date_col: str = "fecha_queja",
                        scale: int = 6) -> DataFrame:
    """Mean, sample std (NULL for a one-month year), min, max per year."""
    return (series.groupBy(F.year(date_col).alias("anio"))
                  .agg(F.round(F.avg(value), scale).alias("media"),
                       F.round(F.stddev_samp(value), scale).alias("desviacion"),
                       F.min(value).alias("minimo"), F.max(value).alias("maximo")))


def series_span(series: DataFrame, date_col: str = "fecha_queja") -> DataFrame:
    return series.agg(F.min(date_col).alias("fecha_inicial"), F.max(date_col).alias("fecha_final"),
                      F.count(F.lit(1)).alias("observaciones"))


def last_periods(series: DataFrame, n: int = 12, date_col: str = "fecha_queja") -> DataFrame:
    return series.orderBy(F.col(date_col).desc()).limit(n)


def forecast_mean(series: DataFrame, value: str = "total_quejas", date_col: str = "fecha_queja",
                  n: int = 6, horizon: int = 3, z: float = 1.96, scale: int = 6) -> DataFrame:
    """Flat forecast: mean of the last ``n`` periods for the next ``horizon``
    months, with a band mean +/- z * sample std (lower bound not clamped).

    The last n rows come from a per-partition top-n (sort + limit), the
    statistics are one row, and the horizon rows are generated from it."""
    last = series.select(date_col, value).orderBy(F.col(date_col).desc()).limit(n)
    st = last.agg(F.avg(value).alias("_m"), F.stddev_samp(value).alias("_s"), F.max(date_col).alias("_d"))
    steps = st.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("paso"))
    mes = F.add_months(F.col("_d"), F.col("paso"))
    return steps.select(
        "paso",
        mes.alias("fecha_pronostico"),
        F.date_format(mes, "yyyy-MM").alias("periodo_mes"),
        F.round(F.col("_m"), scale).alias("prediccion"),
        F.round(F.col("_m") - F.lit(z) * F.col("_s"), scale).alias("intervalo_inferior"),
        F.round(F.col("_m") + F.lit(z) * F.col("_s"), scale).alias("intervalo_superior"),
    )


def fill_calendar(series: DataFrame, value_cols: Sequence[str], date_col: str = "fecha_queja",
                  partition_by: Sequence[str] = ()) -> DataFrame:
    """Complete monthly calendar between the first and last month (per
    partition key), missing months filled with 0."""
    keys = list(partition_by)
    span = series.groupBy(*keys).agg(F.min(date_col).alias("_a"), F.max(date_col).alias("_b"))
    cal = span.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias(date_col))
    out = null_safe(cal, series.select(*keys, date_col, *value_cols), keys + [date_col], "left")
    return out.select(*keys, date_col, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in value_cols])


def seasonal_profile(series: DataFrame, value: str = "total_quejas", date_col: str = "fecha_queja",
                     scale: int = 6) -> DataFrame:
    """Mean per month of the year and its index against the overall mean."""
    per = series.groupBy(F.month(date_col).alias("mes")).agg(
        F.avg(value).alias("media_mes"), F.count(F.lit(1)).alias("observaciones"))
    overall = series.agg(F.avg(value)).scalar()
    return (per.withColumn("indice_estacional", F.round(F.col("media_mes") / overall, 4))
               .withColumn("media_mes", F.round("media_mes", scale)))


def series_anomalies(series: DataFrame, value: str = "total_quejas", date_col: str = "fecha_queja",
                     n: int = 6, threshold: float = 2.0, partition_by: Sequence[str] = (),
                     scale: int = 6) -> DataFrame:
    """z-score of each period against the previous ``n`` periods; flagged
    when |z| > threshold. NULL z when there are fewer than 2 previous
    periods or their std is 0."""
    w = _w(date_col, partition_by).rowsBetween(-n, -1)
    m, s, c = F.avg(value).over(w), F.stddev_samp(value).over(w), F.count(value).over(w)
    z = F.when((c >= 2) & (s > 0), (F.col(value) - m) / s)
    out = series.withColumn("media_previa", m).withColumn("z", z)
    out = out.withColumn("anomalia", F.coalesce(F.abs(F.col("z")) > F.lit(threshold), F.lit(False)))
    return out.withColumn("media_previa", F.round("media_previa", scale)).withColumn("z", F.round("z", scale))
