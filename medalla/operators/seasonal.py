"""Seasonal forecast and change points of monthly series.

A series is the months of one key, at most twelve values a year, so a whole
series is one array (forecast) or one small group (change points); the number
of series may be anything.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalla.operators.ordering import null_safe
from medalla.session import materialize

SEASON = 12
#: smoothing parameters tried: level, trend, season
GRID = tuple(product((0.2, 0.5, 0.8), (0.05, 0.2), (0.1, 0.4)))
#: months whose mean is the flat forecast that the seasonal one is held against
FLAT = 6


def monthly_arrays(monthly: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """``keys``, ``inicio`` (first month) and ``x``: the values of every month
    from the first to the last, 0 where there is none. Several rows of a month
    add up; rows without a date or value are left out."""
    rows = monthly.where(F.col(date).isNotNull() & F.col(value).isNotNull()).select(
        *keys, F.trunc(date, "month").alias("mes"), F.col(value).cast("double").alias("v"))
    rows = rows.groupBy(*keys, "mes").agg(F.sum("v").alias("v"))
    per = rows.groupBy(*keys).agg(F.min("mes").alias("inicio"), F.max("mes").alias("_fin"),
                                  F.map_from_entries(F.collect_list(F.struct("mes", "v"))).alias("_m"))
    every = F.sequence("inicio", "_fin", F.expr("INTERVAL 1 MONTH"))
    return per.select(*keys, "inicio", F.transform(every, lambda m: F.coalesce(F.element_at("_m", m), F.lit(0.0))).alias("x"))


def _mean(x: Column, start, n) -> Column:
    return F.aggregate(F.slice(x, start, n), F.lit(0.0), lambda a, v: a + v) / n


def _smooth(x: Column, a: float, b: float, g: float) -> Column:
    """Additive Holt-Winters over the months from the second year on. The
    state holds level, trend, the next twelve seasonal terms (the first is
    that of the coming month) and the sum of squared one-step errors."""
    first, second = _mean(x, 1, SEASON), _mean(x, SEASON + 1, SEASON)
    start = F.struct(first.alias("level"), ((second - first) / SEASON).alias("trend"),
                     F.transform(F.slice(x, 1, SEASON), lambda v: v - first).alias("season"), F.lit(0.0).alias("sse"))

    def step(s: Column, v: Column) -> Column:
        due = s["season"][0]
        error = v - (s["level"] + s["trend"] + due)
        level = a * (v - due) + (1 - a) * (s["level"] + s["trend"])
        trend = b * (level - s["level"]) + (1 - b) * s["trend"]
        term = g * (v - level) + (1 - g) * due
        return F.struct(level.alias("level"), trend.alias("trend"),
                        F.concat(F.slice(s["season"], 2, SEASON - 1), F.array(term)).alias("season"),
                        (s["sse"] + error * error).alias("sse"))

    return F.aggregate(F.slice(x, SEASON + 1, F.size(x)), start, step)


def seasonal_forecast(monthly: DataFrame, keys: Sequence[str], date: str, value: str, horizon: int = 3,
                      grid: Sequence[tuple] = GRID, scale: int = 6) -> DataFrame:
    """The next ``horizon`` months of every series by additive Holt-Winters.

    For each series the parameters of ``grid`` with the least one-step-ahead
    error from its second year on are taken (ties: the first). Returns ``keys,
    paso, fecha, prediccion, alfa, beta, gama, error_estacional, error_plano``:
    the root mean square one-step errors of this forecast and of the mean of
    the FLAT months before, over the same months. Series of less than two
    years are left out: they have no season to learn. Everything stays in the
    JVM: a fold over each series' array, one per parameter set.
    """
    rows = monthly_arrays(monthly, keys, date, value).where(F.size("x") >= 2 * SEASON)
    fits = F.array(*[F.struct(_smooth(F.col("x"), *p).alias("s"), F.lit(i).alias("i"), *[
        F.lit(float(v)).alias(n) for v, n in zip(p, ("alfa", "beta", "gama"))]) for i, p in enumerate(grid)])
    best = F.aggregate(fits, fits[0], lambda m, f: F.when(f["s"]["sse"] < m["s"]["sse"], f).otherwise(m))
    n = F.size("x") - SEASON
    flat = F.aggregate(F.sequence(F.lit(SEASON + 1), F.size("x")), F.lit(0.0), lambda a, t: a + F.pow(
        F.element_at("x", t) - _mean(F.col("x"), t - FLAT, FLAT), F.lit(2.0)))
    rows = rows.select(*keys, F.add_months("inicio", F.size("x") - 1).alias("_ultimo"), best.alias("_b"),
                       F.sqrt(flat / n).alias("error_plano"), n.alias("_n"))
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("paso")
    rows = rows.select(*keys, step, "_ultimo", "_b", "error_plano", "_n")
    ahead = F.col("_b.s.level") + F.col("paso") * F.col("_b.s.trend") + F.element_at(
        F.col("_b.s.season"), (F.col("paso") - 1) % SEASON + 1)
    return rows.select(*keys, "paso", F.add_months("_ultimo", F.col("paso")).alias("fecha"), F.round(ahead, scale).alias("prediccion"),
                       "_b.alfa", "_b.beta", "_b.gama", F.round(F.sqrt(F.col("_b.s.sse") / F.col("_n")), scale).alias("error_estacional"),
                       F.round("error_plano", scale).alias("error_plano"))


def segments(x: np.ndarray, penalty: float, least: int) -> list[tuple[int, int]]:
    """The cut of ``x`` into runs of at least ``least`` values with the least
    sum of squared distances to the runs' means plus ``penalty`` per run
    (ties: the fewest runs, then the earliest last cut). Exact, by dynamic
    programming over the end of the last run."""
    n = len(x)
    if n < 2 * least:
        return [(0, n)]
    s, q = (np.concatenate(([0.0], np.cumsum(v))) for v in (x, x * x))
    cost, runs, cut = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=int), np.zeros(n + 1, dtype=int)
    cost[0] = 0.0
    for end in range(least, n + 1):
        at = np.arange(0, end - least + 1)
        size = end - at
        total = cost[at] + (q[end] - q[at]) - (s[end] - s[at]) ** 2 / size + penalty
        good = at[total <= total.min() + 1e-9 * max(1.0, abs(total.min()))]
        best = good[np.argmin(runs[good])]
        cost[end], runs[end], cut[end] = total[best], runs[best] + 1, best
    out, end = [], n
    while end:
        out.append((int(cut[end]), end))
        end = int(cut[end])
    return out[::-1]


def default_penalty(x: np.ndarray) -> float:
    """Three times the noise variance times log n; the noise is the median
    size of the steps between neighbours, so level shifts do not count."""
    if len(x) < 2:
        return 1.0
    noise = np.median(np.abs(np.diff(x))) / (0.6745 * np.sqrt(2.0))
    return 3.0 * max(float(noise) ** 2, 1e-6) * np.log(len(x))


def change_points(monthly: DataFrame, keys: Sequence[str], date: str, value: str, least: int = 3,
                  penalty: float | None = None, scale: int = 6) -> DataFrame:
    """Level segments of every monthly series (months without a row are 0):
    ``keys, segmento`` (from 1), ``desde, hasta`` (months), ``meses, total,
    media, cambio`` (mean less that of the segment before; null in the
    first). ``penalty`` is per segment; None takes ``default_penalty``. A
    series is one group of at most twelve values a year."""
    rows = monthly_arrays(monthly, keys, date, value)
    kinds = dict(rows.dtypes)

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for record in pdf.itertuples(index=False):
            *ids, start, x = record
            x = np.asarray(x, dtype=float)
            before = None
            for i, (lo, hi) in enumerate(segments(x, default_penalty(x) if penalty is None else penalty, least)):
                mean = float(x[lo:hi].mean())
                first = pd.Timestamp(start)
                out.append((*ids, i + 1, (first + pd.DateOffset(months=lo)).date(), (first + pd.DateOffset(months=hi - 1)).date(),
                            hi - lo, float(x[lo:hi].sum()), round(mean, scale), None if before is None else round(mean - before, scale)))
                before = mean
        return pd.DataFrame(out, columns=names)

    names = [*keys, "segmento", "desde", "hasta", "meses", "total", "media", "cambio"]
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "segmento int, desde date, hasta date, meses int, total double, "
                        "media double, cambio double"])
    return rows.mapInPandas(lambda batches: (cut(b) for b in batches if len(b)), schema)


def change_checks(found: DataFrame, monthly: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """Facts that hold for any right segmentation, as (control, valor): the
    series, the months and the total that the segments cover, and segments
    that overlap another one of their series or leave a gap."""
    ends = found.groupBy(*keys).agg(F.min("desde").alias("a"), F.max("hasta").alias("b"), F.sum("meses").alias("n"), F.sum("total").alias("t"))
    ends = materialize(ends, "change-ends")  # read twice, the series are cut once
    span = F.months_between("b", "a") + 1
    facts = ends.agg(F.count(F.lit(1)).alias("series"), F.sum("n").alias("meses"), F.sum("t").alias("total"),
                     F.sum((F.col("n") != span).cast("long")).alias("huecos"))
    per = monthly.groupBy(*keys).agg(F.sum(value).alias("_t"))
    off = null_safe(ends, per, list(keys)).where(F.col("t") != F.col("_t")).agg(F.count(F.lit(1))).scalar()
    pairs = [("series", F.col("series")), ("meses", F.col("meses")), ("total", F.col("total")), ("huecos", F.col("huecos")),
             ("totales_distintos", off)]
    return facts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("control"), c.cast("long").alias("valor")) for n, c in pairs])))
