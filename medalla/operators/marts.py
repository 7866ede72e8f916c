"""Gold marts and distributions: entity, product, month, KPIs, shares, top-k.

All marts are one ``groupBy().agg()`` each: Spark aggregates partially on the
map side before the shuffle, so a hot key (one entity holding a third of the
complaints) reaches the shuffle as a handful of partial rows. Several
``countDistinct`` in one aggregate become one Expand + two-level hash
aggregate, also partial on both levels. Percentages of the table total read
the written aggregate twice, not its input. The marts also take a count cube
(operators/cube): ``weight`` names its count column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalla.functions.scalar import normalize_month, normalize_year, pct
from medalla.operators.ordering import global_rank
from medalla.schema import (
    ENTITY_KEYS,
    KPI_AVG_PER_ENTITY,
    KPI_ENTITIES,
    KPI_PCT_BANKS,
    KPI_PCT_OPEN,
    KPI_PRODUCTS,
    KPI_TOTAL,
    MONTH_KEYS,
    STATE_OPEN,
    STATE_RECEIVED,
    TYPE_BANK,
    TYPE_INSURANCE,
    TYPE_PENSION,
)
from medalla.session import materialize


def distinct_count(c: str, approx: bool = False) -> Column:
    """Exact ``countDistinct`` (Catalyst expands each row once per distinct
    column), or with ``approx`` a HyperLogLog++ sketch (``rsd`` 1 %): one
    pass, fixed memory per group, no Expand - for very large tables where
    an estimate is acceptable."""
    return F.approx_count_distinct(c, rsd=0.01) if approx else F.countDistinct(c)


def row_count(weight: str | None = None) -> Column:
    """Rows, or with ``weight`` the rows that the input's rows stand for (a
    count column, as in a count cube)."""
    return F.coalesce(F.sum(weight), F.lit(0).cast("long")) if weight else F.count(F.lit(1))


def count_if(cond: Column, weight: str | None = None) -> Column:
    """sum(when(cond, 1).otherwise(0)): a bigint count of rows meeting cond."""
    return F.sum(F.when(cond, F.col(weight) if weight else F.lit(1)).otherwise(F.lit(0)))


def with_total_share(agg: DataFrame, count_col: str, out_col: str, scale: int = 2) -> DataFrame:
    """Add round(count * 100 / sum(count), scale). The aggregate is written
    once and read for the total (a scalar subquery) and for the rows, so the
    input is scanned once."""
    agg = materialize(agg, "share")
    total = agg.agg(F.sum(count_col)).scalar()
    return agg.withColumn(out_col, pct(F.col(count_col), total, scale))


def _order_desc(metric: str, keys: Sequence[str]) -> list:
    return [F.col(metric).desc()] + [F.col(k).asc() for k in keys]


# ---------------------------------------------------------------- entity mart
def entity_metrics(silver: DataFrame, keys: Sequence[str] = ENTITY_KEYS, rank: bool = True,
                   approx: bool = False, weight: str | None = None) -> DataFrame:
    """One row per entity: volume, diversity, first/last month, months with
    complaints, open/received counts, mean per active month and rank."""
    keys = list(keys)
    agg = silver.groupBy(*keys).agg(
        row_count(weight).alias("total_quejas"),
        distinct_count("producto", approx).alias("productos_distintos"),
        distinct_count("motivo", approx).alias("motivos_distintos"),
        F.min("fecha_queja").alias("primera_queja"),
        F.max("fecha_queja").alias("ultima_queja"),
        distinct_count("periodo_mes", approx).alias("meses_con_quejas"),
        count_if(F.col("estado") == STATE_OPEN, weight).alias("quejas_vigentes"),
        count_if(F.col("estado") == STATE_RECEIVED, weight).alias("quejas_recibidas"),
        F.round(row_count(weight) / distinct_count("periodo_mes", approx), 2).alias("promedio_quejas_por_mes"),
    )
    if not rank:
        return agg
    return global_rank(agg, _order_desc("total_quejas", keys), "ranking_quejas")


# --------------------------------------------------------------- product mart
def product_metrics(silver: DataFrame, product: str = "producto", rank: bool = True,
                    approx: bool = False, weight: str | None = None) -> DataFrame:
    agg = silver.groupBy(product).agg(
        row_count(weight).alias("total_quejas"),
        distinct_count("nombre_entidad", approx).alias("entidades_afectadas"),
        distinct_count("motivo", approx).alias("motivos_distintos"),
        count_if(F.col("tipo_entidad_desc") == TYPE_BANK, weight).alias("quejas_bancos"),
        count_if(F.col("tipo_entidad_desc") == TYPE_PENSION, weight).alias("quejas_pensiones"),
        count_if(F.col("tipo_entidad_desc") == TYPE_INSURANCE, weight).alias("quejas_seguros"),
        F.min("anio").alias("anio_inicial"),
        F.max("anio").alias("anio_final"),
        distinct_count("periodo_mes", approx).alias("meses_con_quejas"),
    )
    agg = with_total_share(agg, "total_quejas", "porcentaje_total")
    if not rank:
        return agg
    return global_rank(agg, _order_desc("total_quejas", [product]), "ranking_producto")


# --------------------------------------------------------------- monthly mart
def monthly_base(silver: DataFrame, keys: Sequence[str] = MONTH_KEYS, approx: bool = False,
                 weight: str | None = None) -> DataFrame:
    return silver.groupBy(*keys).agg(
        row_count(weight).alias("total_quejas"),
        distinct_count("nombre_entidad", approx).alias("entidades_con_quejas"),
        distinct_count("producto", approx).alias("productos_distintos"),
        count_if(F.col("tipo_entidad_desc") == TYPE_BANK, weight).alias("quejas_bancos"),
        count_if(F.col("tipo_entidad_desc") == TYPE_PENSION, weight).alias("quejas_pensiones"),
        count_if(F.col("tipo_entidad_desc") == TYPE_INSURANCE, weight).alias("quejas_seguros"),
        count_if(F.col("estado") == STATE_OPEN, weight).alias("quejas_vigentes"),
        count_if(F.col("estado") == STATE_RECEIVED, weight).alias("quejas_recibidas"),
    )


def monthly_metrics(silver: DataFrame, date_col: str = "fecha_queja", approx: bool = False,
                    weight: str | None = None) -> DataFrame:
    """Monthly mart with the trailing 3-month mean and the trend label.

    The series has one row per calendar month present, so its window runs
    over at most 12 rows per year of data: a bounded single-partition window.
    """
    from medalla.operators.series import moving_average, with_trend

    base = monthly_base(silver, approx=approx, weight=weight)
    ma = moving_average(base, "total_quejas", date_col, 3, "promedio_movil_3meses")
    return with_trend(ma, "total_quejas", date_col, "tendencia").orderBy(date_col)


# ----------------------------------------------------------------- KPI table
def kpi_table(silver: DataFrame, entity: str = "nombre_entidad", product: str = "producto",
              stamp: bool = False, weight: str | None = None) -> DataFrame:
    """Six dashboard KPIs from ONE aggregate over silver, unpivoted to rows
    (kpi_nombre, kpi_valor, kpi_categoria, kpi_descripcion)."""
    a = silver.agg(
        row_count(weight).alias("n"),
        F.countDistinct(entity).alias("ents"),
        F.countDistinct(product).alias("prods"),
        count_if(F.col("tipo_entidad_desc") == TYPE_BANK, weight).alias("banks"),
        count_if(F.col("estado") == STATE_OPEN, weight).alias("open"),
    )
    values = [
        (KPI_TOTAL, F.col("n").cast("double")),
        (KPI_ENTITIES, F.col("ents").cast("double")),
        (KPI_AVG_PER_ENTITY, F.round(F.try_divide(F.col("n"), F.col("ents")), 2)),
        (KPI_PCT_BANKS, pct("banks", "n")),
        (KPI_PRODUCTS, F.col("prods").cast("double")),
        (KPI_PCT_OPEN, pct("open", "n")),
    ]
    rows = F.array(*[
        F.struct(F.lit(i).alias("kpi_orden"), F.lit(name).alias("kpi_nombre"),
                 v.cast("double").alias("kpi_valor"), F.lit(cat).alias("kpi_categoria"),
                 F.lit(desc).alias("kpi_descripcion"))
        for i, ((name, cat, desc), v) in enumerate(values, start=1)])
    out = a.select(F.inline(rows)).drop("kpi_orden")
    if stamp:
        out = out.withColumn("fecha_actualizacion", F.current_timestamp())
    return out


# -------------------------------------------------------------- distributions
def yearly_distribution(raw: DataFrame, year: str = "ANIO", month: str = "MES",
                        entity: str = "NOMBRE_ENTIDAD") -> DataFrame:
    """Raw complaints per (normalised) year: count, distinct entities, mean
    month (1 decimal). Years and months are normalised first so that
    min/max/mean are numeric, not textual."""
    return (raw.select(normalize_year(year).alias("anio"), normalize_month(month).alias("_mes"), entity)
               .groupBy("anio").agg(
                   F.count(F.lit(1)).alias("total_quejas"),
                   F.countDistinct(entity).alias("entidades_con_quejas"),
                   F.round(F.avg("_mes"), 1).alias("mes_promedio")).orderBy("anio"))


def top_entities(raw: DataFrame, n: int = 10, entity: str = "NOMBRE_ENTIDAD",
                 product: str = "PRODUCTO", reason: str = "MOTIVO") -> DataFrame:
    """Top-n raw entities by complaints with product/reason diversity.
    Sort + limit plans as a per-partition top-n and one merge of n rows per
    partition (TakeOrderedAndProject)."""
    agg = raw.groupBy(entity).agg(
        F.count(F.lit(1)).alias("total_quejas"),
        F.countDistinct(product).alias("productos_diferentes"),
        F.countDistinct(reason).alias("motivos_diferentes"))
    return agg.orderBy(F.col("total_quejas").desc(), F.col(entity).asc()).limit(n)


def share_by(df: DataFrame, by: str, entity: str | None = None, count_name: str = "total_quejas",
             entities_name: str = "cantidad_entidades", share_name: str = "porcentaje") -> DataFrame:
    """Rows per value of ``by``, distinct entities, and share of all rows,
    largest first."""
    aggs = [F.count(F.lit(1)).alias(count_name)]
    if entity:
        aggs.append(F.countDistinct(entity).alias(entities_name))
    out = with_total_share(df.groupBy(by).agg(*aggs), count_name, share_name)
    return out.orderBy(F.col(count_name).desc(), F.col(by).asc())


def top_products(silver: DataFrame, n: int = 15, product: str = "producto") -> DataFrame:
    return (silver.groupBy(product).agg(F.count(F.lit(1)).alias("total_quejas"))
                  .orderBy(F.col("total_quejas").desc(), F.col(product).asc()).limit(n))


def top_n(df: DataFrame, by: str, n: int, ascending: bool = True, tie_break: Sequence[str] = ()) -> DataFrame:
    o = F.col(by).asc() if ascending else F.col(by).desc()
    return df.orderBy(o, *[F.col(c).asc() for c in tie_break]).limit(n)
