"""Concentration, cross tabs, lift and single-entity views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalla.functions.scalar import pct
from medalla.operators.ordering import null_safe, running_total
from medalla.schema import ENTITY_KEYS
from medalla.session import materialize

def pareto(entity: DataFrame, value: str = "total_quejas", keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Pareto curve: entities by ``value`` descending (ties by key), with
    cumulative value, cumulative share of the total and share of entities."""
    keys = list(keys)
    order = [F.col(value).desc()] + [F.col(k).asc() for k in keys]
    tot = entity.agg(F.struct(F.sum(value).alias("t"), F.count(F.lit(1)).alias("n"))).scalar()
    cur = running_total(entity.select(*keys, value), value, order)
    return (cur.withColumn("porcentaje_acumulado", F.round(F.col("acumulado") * 100.0 / tot.getField("t"), 4))
               .withColumn("porcentaje_entidades", F.round(F.col("posicion") * 100.0 / tot.getField("n"), 4)))


def pareto_summary(entity: DataFrame, value: str = "total_quejas", top_pct: int = 20,
                   keys: Sequence[str] = ENTITY_KEYS) -> DataFrame:
    """Share of the total held by the top ``top_pct`` % of entities
    (ceil(n * top_pct / 100) entities)."""
    curve = pareto(entity, value, keys)
    n = entity.agg(F.count(F.lit(1))).scalar()
    top = ((n * top_pct + 99) / 100).cast("long")
    hit = curve.filter(F.col("posicion") == top)
    return hit.select(n.alias("entidades"), top.alias("entidades_top"),
                      F.lit(top_pct).alias("porcentaje_entidades_top"),
                      F.col("porcentaje_acumulado").alias("porcentaje_quejas_top"))


def pivot_counts(df: DataFrame, rows: str, cols: str, values: Sequence[str]) -> DataFrame:
    """Cross tab of row counts: one row per ``rows`` value, one column per
    listed ``cols`` value (0 where absent) and ``otros`` for all other values,
    NULL included, so every row is counted. The value list is explicit, so
    no extra job is needed to discover it."""
    known = F.col(cols).isin(*values)
    p = df.groupBy(rows).agg(*[F.count(F.when(F.col(cols) == v, 1)).alias(str(v)) for v in values],
                             F.count(F.when(~F.coalesce(known, F.lit(False)), 1)).alias("otros"))
    return p


def lift(df: DataFrame, item: str = "producto", group: str = "tipo_entidad_desc") -> DataFrame:
    """For each (item, group): count, the item's share inside the group, its
    share overall, and lift = share in group / share overall. Everything
    after the first aggregate reads the written (item, group) counts; NULL
    items and groups count as any other."""
    c = materialize(df.groupBy(item, group).agg(F.count(F.lit(1)).alias("quejas")), "lift-counts")
    g = c.groupBy(group).agg(F.sum("quejas").alias("_g"))
    i = c.groupBy(item).agg(F.sum("quejas").alias("_i"))
    t = c.agg(F.sum("quejas")).scalar()
    out = null_safe(null_safe(c, g, [group]), i, [item])
    share_g = F.col("quejas") / F.col("_g")
    share_t = F.col("_i") / t
    return out.select(
        item, group, "quejas",
        F.round(share_g * 100.0, 4).alias("participacion_en_grupo"),
        F.round(share_t * 100.0, 4).alias("participacion_total"),
        F.round(share_g / share_t, 4).alias("lift"))


def entity_products(silver: DataFrame, entity: str | None = None, name: str = "nombre_entidad",
                    product: str = "producto") -> DataFrame:
    """Products of one entity: its complaints, the market's, its share of the
    product's complaints and the product's share of its own, largest first.
    Default entity: the one with most complaints (ties by name); the rows
    without a name are an entity like any other. Everything
    reads one written (entity, product) count table."""
    c = materialize(silver.groupBy(name, product).agg(F.count(F.lit(1)).alias("quejas_entidad")), "entity-products")
    if entity is None:
        target = (c.groupBy(name).agg(F.sum("quejas_entidad").alias("_c"))
                  .orderBy(F.col("_c").desc(), F.col(name).asc()).limit(1).select(name).scalar())
    else:
        target = F.lit(entity)
    own = c.filter(F.col(name).eqNullSafe(target) if entity is None else F.col(name) == target)
    market = c.groupBy(product).agg(F.sum("quejas_entidad").alias("quejas_mercado"))
    total = own.agg(F.sum("quejas_entidad")).scalar()
    return (null_safe(own, market, [product])
            .select(name, product, "quejas_entidad", "quejas_mercado",
                    pct("quejas_entidad", "quejas_mercado").alias("participacion_en_producto"),
                    pct(F.col("quejas_entidad"), total).alias("participacion_en_entidad"))
            .orderBy(F.col("quejas_entidad").desc(), product))


def entity_drilldown(silver: DataFrame, entity: str | None = None, name: str = "nombre_entidad",
                     date_col: str = "fecha_queja", period: str = "periodo_mes") -> DataFrame:
    """Monthly complaints of one entity next to the whole market, with its
    market share. Default entity: the one with most complaints (ties by
    name) - a top-1 scalar subquery inside the plan."""
    if entity is None:
        target = (silver.groupBy(name).agg(F.count(F.lit(1)).alias("_c"))
                        .orderBy(F.col("_c").desc(), F.col(name).asc()).limit(1).select(name).scalar())
    else:
        target = F.lit(entity)
    market = (silver.groupBy(date_col, period).agg(F.count(F.lit(1)).alias("quejas_mercado"))
                    .withColumn(name, target))
    # a given name is pushed to the scan as an equality
    own = (silver.filter(F.col(name).eqNullSafe(target) if entity is None else F.col(name) == target)
                 .groupBy(date_col, period).agg(F.count(F.lit(1)).alias("quejas_entidad")))
    out = null_safe(market, own, [date_col, period], "left")
    return out.select(name, date_col, period,
                      F.coalesce("quejas_entidad", F.lit(0).cast("bigint")).alias("quejas_entidad"),
                      "quejas_mercado",
                      pct(F.coalesce("quejas_entidad", F.lit(0)), F.col("quejas_mercado")).alias("participacion"))
