"""Registered queries: one per operator, each reading the test tables.

Each query is ``(spark, sf_dir) -> DataFrame`` and runs over the whole
tables. ``SQL`` holds the independent DuckDB statement of the same result
(column names and types aligned) where one exists; queries without one (the
K-Means family, schema metadata) are checked on invariants in the tests.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalla import oracle_sql as O
from medalla.functions import scalar as S
from medalla.operators import analysis as A
from medalla.operators import conform as C
from medalla.operators import cube as K
from medalla.operators import eda as E
from medalla.operators import evolution as V
from medalla.operators import inference as I
from medalla.operators import marts as M
from medalla.operators import neighbours as N
from medalla.operators import patterns as P
from medalla.operators import quality as Q
from medalla.operators import ranking as R
from medalla.operators import seasonal as W
from medalla.operators import segment as G
from medalla.operators import series as T
from medalla.operators import text as X
from medalla.plans.layers import bronze_layer, cube_layer, entity_layer, segments_layer, silver_layer
from medalla.schema import ENTITY_FEATURES, ENTITY_KEYS, RAW_COLUMNS
from medalla.sources.star import raw_from_star, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """The written bronze layer (raw rows shaped once per session from the
    star tables), as the bronze profiles and the conform step read it."""
    return bronze_layer(spark, sf)


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """The written silver layer (conformed once per session from the raw
    star tables), as gold queries read it."""
    return silver_layer(spark, sf)


def entity(spark: SparkSession, sf: str) -> DataFrame:
    """The written gold entity mart, as the analytics queries read it."""
    return entity_layer(spark, sf)


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return M.monthly_metrics(silver(spark, sf))


r2, r6 = O.r2, (lambda e: O.r2(e, 6))
_EKEYS = ", ".join(ENTITY_KEYS)
_RANKED_ENTITY = f"""ranked_entity AS (
  SELECT *, CAST(row_number() OVER (ORDER BY total_quejas DESC, {_EKEYS}) AS BIGINT) AS ranking_quejas
  FROM entity)"""
_RANKINGS = """per AS (
  SELECT nombre_entidad, tipo_entidad_desc, count(*) AS t, count(DISTINCT producto) AS p,
         count(*) FILTER (WHERE anio = (SELECT max(anio) FROM silver)) AS r
  FROM silver GROUP BY nombre_entidad, tipo_entidad_desc),
st AS (
  SELECT nombre_entidad, tipo_entidad_desc, 'total_quejas' AS ranking_tipo, t AS total_quejas FROM per
  UNION ALL SELECT nombre_entidad, tipo_entidad_desc, 'productos_distintos', p FROM per
  UNION ALL SELECT nombre_entidad, tipo_entidad_desc, 'quejas_' || CAST((SELECT max(anio) FROM silver) AS VARCHAR), r
  FROM per WHERE r > 0),
rankings AS (
  SELECT nombre_entidad, tipo_entidad_desc, total_quejas, ranking_tipo,
         CAST(row_number() OVER (PARTITION BY ranking_tipo
              ORDER BY total_quejas DESC, nombre_entidad, tipo_entidad_desc) AS BIGINT) AS posicion
  FROM st)"""


# =========================================================== bronze profile
@register("dataset_profile", O.on_raw("""
SELECT count(*) AS total_registros, count(DISTINCT ANIO) AS total_anios, min(anio_n) AS anio_inicial,
  max(anio_n) AS anio_final, count(DISTINCT NOMBRE_ENTIDAD) AS total_entidades,
  count(DISTINCT PRODUCTO) AS total_productos, count(DISTINCT MOTIVO) AS total_motivos,
  count(DISTINCT ESTADO) AS total_estados, count(DISTINCT TIPO_ENTIDAD) AS total_tipos_entidad
FROM parsed""", O.PARSED))
def q_dataset_profile(spark, sf):
    return Q.dataset_profile(raw(spark, sf))


@register("null_profile", O.on_raw("\nUNION ALL\n".join(
    f"SELECT '{c}' AS columna, count(*) - count({c}) AS valores_nulos, "
    f"{r2(f'(count(*) - count({c})) * 100e0 / count(*)')} AS porcentaje_nulos FROM raw"
    for c in RAW_COLUMNS)))
def q_null_profile(spark, sf):
    return Q.null_profile(raw(spark, sf))


@register("marker_profile", O.on_raw("\nUNION ALL\n".join(
    f"SELECT '{c}' AS columna, count(*) FILTER (WHERE upper(trim({c})) = 'NA') AS cantidad, "
    f"{r2(f'count(*) FILTER (WHERE upper(trim({c})) = ' + chr(39) + 'NA' + chr(39) + ') * 100e0 / count(*)')}"
    f" AS porcentaje FROM raw" for c in ("PRODUCTO", "MOTIVO"))))
def q_marker_profile(spark, sf):
    return Q.marker_profile(raw(spark, sf))


@register("yearly_distribution", O.on_raw(f"""
SELECT anio_n AS anio, count(*) AS total_quejas, count(DISTINCT NOMBRE_ENTIDAD) AS entidades_con_quejas,
  {O.r2('avg(mes_n)', 1)} AS mes_promedio
FROM parsed GROUP BY anio_n""", O.PARSED))
def q_yearly_distribution(spark, sf):
    return M.yearly_distribution(raw(spark, sf))


@register("top_entities", O.on_raw("""
SELECT NOMBRE_ENTIDAD, count(*) AS total_quejas, count(DISTINCT PRODUCTO) AS productos_diferentes,
  count(DISTINCT MOTIVO) AS motivos_diferentes
FROM raw GROUP BY NOMBRE_ENTIDAD ORDER BY total_quejas DESC, NOMBRE_ENTIDAD LIMIT 10"""))
def q_top_entities(spark, sf):
    return M.top_entities(raw(spark, sf))


@register("share_by_raw_type", O.on_raw(f"""
SELECT TIPO_ENTIDAD, count(*) AS total_quejas, count(DISTINCT NOMBRE_ENTIDAD) AS cantidad_entidades,
  {r2('count(*) * 100e0 / sum(count(*)) OVER ()')} AS porcentaje
FROM raw GROUP BY TIPO_ENTIDAD"""))
def q_share_by_raw_type(spark, sf):
    return M.share_by(raw(spark, sf), "TIPO_ENTIDAD", "NOMBRE_ENTIDAD")


_SILVER_TYPES = [("tipo_entidad_id", "int"), ("codigo_entidad", "int"), ("nombre_entidad", "string"),
                 ("producto", "string"), ("motivo", "string"), ("estado", "string"), ("mes", "int"),
                 ("fecha_queja", "date"), ("periodo_mes", "string"), ("trimestre", "string"),
                 ("tipo_entidad_desc", "string"), ("anio", "int")]  # the folder column comes last


@register("schema_profile", O.on_silver("\nUNION ALL\n".join(
    f"SELECT CAST({i + 1} AS INTEGER) AS posicion, '{c}' AS columna, '{t}' AS tipo, true AS nullable, "
    f"count({c}) AS valores_no_nulos FROM silver" for i, (c, t) in enumerate(_SILVER_TYPES))))
def q_schema_profile(spark, sf):
    return Q.schema_profile(silver(spark, sf))


# ============================================================ scalar rules
@register("normalize_year", O.on_raw("""
SELECT ANIO, anio_n AS anio_normalizado, count(*) AS filas FROM parsed GROUP BY ANIO, anio_n""", O.PARSED))
def q_normalize_year(spark, sf):
    return (raw(spark, sf).groupBy("ANIO", S.normalize_year("ANIO").alias("anio_normalizado"))
            .agg(F.count(F.lit(1)).alias("filas")))


@register("standardize_name", O.on_raw(r"""
SELECT NOMBRE_ENTIDAD,
  trim(regexp_replace(regexp_replace(upper(NOMBRE_ENTIDAD), '\s+S\.A\.?\s*$', ''), '\s+LTDA\.?\s*$', '')) AS nombre_estandar,
  count(*) AS filas
FROM raw GROUP BY 1, 2"""))
def q_standardize_name(spark, sf):
    return (raw(spark, sf).groupBy("NOMBRE_ENTIDAD", S.standardize_name("NOMBRE_ENTIDAD").alias("nombre_estandar"))
            .agg(F.count(F.lit(1)).alias("filas")))


@register("fill_unspecified", O.on_raw("""
SELECT PRODUCTO, CASE WHEN upper(trim(PRODUCTO)) = 'NA' OR PRODUCTO IS NULL THEN 'NO ESPECIFICADO'
                      ELSE trim(PRODUCTO) END AS producto_std, count(*) AS filas
FROM raw GROUP BY 1, 2"""))
def q_fill_unspecified(spark, sf):
    return (raw(spark, sf).groupBy("PRODUCTO", S.fill_unspecified("PRODUCTO").alias("producto_std"))
            .agg(F.count(F.lit(1)).alias("filas")))


@register("categorize", O.on_raw("""
SELECT TIPO_ENTIDAD,
  CASE WHEN tip_n = 1 THEN 'BANCO' WHEN tip_n IN (23, 24, 25) THEN 'PENSION Y CESANTIAS'
       WHEN tip_n IN (2, 3) THEN 'CORPORACION FINANCIERA' WHEN tip_n IN (5, 6) THEN 'SEGUROS'
       WHEN tip_n IN (7, 8) THEN 'SOCIEDADES FIDUCIARIAS' ELSE 'OTRA ENTIDAD FINANCIERA' END AS categoria,
  count(*) AS filas
FROM parsed GROUP BY 1, 2""", O.PARSED))
def q_categorize(spark, sf):
    return (raw(spark, sf).groupBy("TIPO_ENTIDAD", S.categorize(S.parse_code("TIPO_ENTIDAD")).alias("categoria"))
            .agg(F.count(F.lit(1)).alias("filas")))


@register("month_key", O.on_silver("""
SELECT anio, mes, periodo_mes, count(*) AS filas FROM silver GROUP BY 1, 2, 3"""))
def q_month_key(spark, sf):
    return silver(spark, sf).groupBy("anio", "mes", "periodo_mes").agg(F.count(F.lit(1)).alias("filas"))


@register("quarter_label", O.on_silver("""
SELECT mes, trimestre, count(*) AS filas FROM silver GROUP BY 1, 2"""))
def q_quarter_label(spark, sf):
    return silver(spark, sf).groupBy("mes", "trimestre").agg(F.count(F.lit(1)).alias("filas"))


# ================================================================== silver
@register("conform", O.on_silver("SELECT * FROM silver"))
def q_conform(spark, sf):
    return C.conform(raw(spark, sf))


@register("conform_stamped", O.on_silver("SELECT *, true AS con_marca FROM silver"))
def q_conform_stamped(spark, sf):
    """Silver with the processing timestamp (P11), shown as whether it lies
    within the hour: a clock value itself has no oracle."""
    out = C.conform(raw(spark, sf), stamp=True)
    age = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("fecha_procesamiento"))
    return out.withColumn("con_marca", age < 3600).drop("fecha_procesamiento")


@register("rejects", O.on_raw("""
SELECT TIPO_ENTIDAD, CODIGO_ENTIDAD, NOMBRE_ENTIDAD, PRODUCTO, MOTIVO, ESTADO, ANIO, MES,
  CASE WHEN anio_n IS NULL THEN 'ANIO_INVALIDO'
       WHEN mes_n IS NULL OR NOT (mes_n BETWEEN 1 AND 12) THEN 'MES_INVALIDO'
       WHEN tip_n IS NULL THEN 'TIPO_ENTIDAD_INVALIDO'
       WHEN cod_n IS NULL THEN 'CODIGO_ENTIDAD_INVALIDO' END AS motivo_rechazo
FROM parsed
WHERE NOT coalesce(anio_n IS NOT NULL AND mes_n BETWEEN 1 AND 12 AND tip_n IS NOT NULL AND cod_n IS NOT NULL, false)
""", O.PARSED))
def q_rejects(spark, sf):
    return C.rejects(raw(spark, sf))


@register("sample_rows", O.on_silver("""
SELECT tipo_entidad_desc, nombre_entidad, producto, motivo, estado, fecha_queja, periodo_mes, trimestre
FROM silver
ORDER BY tipo_entidad_desc NULLS FIRST, nombre_entidad NULLS FIRST, producto NULLS FIRST, motivo NULLS FIRST,
  estado NULLS FIRST, fecha_queja NULLS FIRST, periodo_mes NULLS FIRST, trimestre NULLS FIRST
LIMIT 10"""))
def q_sample_rows(spark, sf):
    return Q.sample_rows(silver(spark, sf), 10, ["tipo_entidad_desc", "nombre_entidad", "producto", "motivo",
                                                  "estado", "fecha_queja", "periodo_mes", "trimestre"])


@register("silver_verification", O.on_silver("""
SELECT count(*) AS total_registros, count(DISTINCT anio) AS total_anios, min(fecha_queja) AS fecha_minima,
  max(fecha_queja) AS fecha_maxima, count(DISTINCT nombre_entidad) AS total_entidades,
  count(DISTINCT producto) AS total_productos
FROM silver"""))
def q_silver_verification(spark, sf):
    return Q.silver_verification(silver(spark, sf))


@register("default_value_profile", O.on_silver("\nUNION ALL\n".join(
    f"SELECT '{c}' AS columna, count(*) FILTER (WHERE {c} = 'NO ESPECIFICADO') AS cantidad, "
    f"{r2(f'count(*) FILTER (WHERE {c} = ' + chr(39) + 'NO ESPECIFICADO' + chr(39) + ') * 100e0 / count(*)')}"
    f" AS porcentaje FROM silver" for c in ("producto", "motivo"))))
def q_default_value_profile(spark, sf):
    return Q.default_value_profile(silver(spark, sf))


@register("share_by", O.on_silver(f"""
SELECT tipo_entidad_desc, count(*) AS total_quejas, count(DISTINCT nombre_entidad) AS cantidad_entidades,
  {r2('count(*) * 100e0 / sum(count(*)) OVER ()')} AS porcentaje_total
FROM silver GROUP BY tipo_entidad_desc"""))
def q_share_by(spark, sf):
    return M.share_by(silver(spark, sf), "tipo_entidad_desc", "nombre_entidad", share_name="porcentaje_total")


@register("date_validation", O.on_silver("""
SELECT anio, count(*) AS registros, min(fecha_queja) AS primera_fecha, max(fecha_queja) AS ultima_fecha,
  count(DISTINCT periodo_mes) AS meses_con_datos,
  (year(min(fecha_queja)) = anio AND year(max(fecha_queja)) = anio AND count(DISTINCT periodo_mes) <= 12
   AND anio BETWEEN 1900 AND 2100) AS fechas_validas
FROM silver GROUP BY anio"""))
def q_date_validation(spark, sf):
    return Q.date_validation(silver(spark, sf))


@register("completeness", O.on_silver(f"""
SELECT count(*) AS total_registros, count(nombre_entidad) AS nombre_entidad_completo,
  count(producto) AS producto_completo, count(motivo) AS motivo_completo, count(estado) AS estado_completo,
  count(fecha_queja) AS fecha_queja_completa,
  {r2('count(fecha_queja) * 100e0 / count(*)')} AS porcentaje_completitud
FROM silver"""))
def q_completeness(spark, sf):
    return Q.completeness(silver(spark, sf))


# ============================================================== gold marts
@register("entity_metrics", O.on_silver("SELECT * FROM ranked_entity", O.ENTITY, _RANKED_ENTITY))
def q_entity_metrics(spark, sf):
    return M.entity_metrics(silver(spark, sf))


@register("product_metrics", O.on_silver(f"""
SELECT producto, count(*) AS total_quejas, count(DISTINCT nombre_entidad) AS entidades_afectadas,
  count(DISTINCT motivo) AS motivos_distintos,
  CAST(sum(CASE WHEN tipo_entidad_desc = 'BANCO' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_bancos,
  CAST(sum(CASE WHEN tipo_entidad_desc = 'PENSION Y CESANTIAS' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_pensiones,
  CAST(sum(CASE WHEN tipo_entidad_desc = 'SEGUROS' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_seguros,
  min(anio) AS anio_inicial, max(anio) AS anio_final, count(DISTINCT periodo_mes) AS meses_con_quejas,
  {r2('count(*) * 100e0 / sum(count(*)) OVER ()')} AS porcentaje_total,
  CAST(row_number() OVER (ORDER BY count(*) DESC, producto) AS BIGINT) AS ranking_producto
FROM silver GROUP BY producto"""))
def q_product_metrics(spark, sf):
    return M.product_metrics(silver(spark, sf))


@register("monthly_metrics", O.on_silver("SELECT * FROM monthly", O.MONTHLY))
def q_monthly_metrics(spark, sf):
    return monthly(spark, sf)


@register("rankings", O.on_silver("SELECT * FROM rankings", _RANKINGS))
def q_rankings(spark, sf):
    return R.rankings(silver(spark, sf))


@register("kpi_table", O.on_silver("""
SELECT 'Total Quejas' AS kpi_nombre, CAST(n AS DOUBLE) AS kpi_valor, 'GENERAL' AS kpi_categoria,
  'Total de quejas registradas en el periodo 2015-2020' AS kpi_descripcion FROM a
UNION ALL SELECT 'Entidades con Quejas', CAST(ents AS DOUBLE), 'GENERAL',
  'Número de entidades financieras con al menos una queja' FROM a
UNION ALL SELECT 'Promedio Quejas por Entidad', """ + r2("n / ents") + """, 'PROMEDIO',
  'Promedio de quejas por entidad financiera' FROM a
UNION ALL SELECT 'Porcentaje Quejas Bancos', """ + r2("banks * 100e0 / n") + """, 'DISTRIBUCION',
  'Porcentaje de quejas contra bancos' FROM a
UNION ALL SELECT 'Productos Distintos', CAST(prods AS DOUBLE), 'GENERAL',
  'Número de productos financieros con quejas' FROM a
UNION ALL SELECT 'Quejas Vigentes Porcentaje', """ + r2("vig * 100e0 / n") + """, 'ESTADO',
  'Porcentaje de quejas con estado VIGENTES' FROM a""", """a AS (
  SELECT count(*) AS n, count(DISTINCT nombre_entidad) AS ents, count(DISTINCT producto) AS prods,
    count(*) FILTER (WHERE tipo_entidad_desc = 'BANCO') AS banks,
    count(*) FILTER (WHERE estado = 'VIGENTES') AS vig
  FROM silver)"""))
def q_kpi_table(spark, sf):
    return M.kpi_table(silver(spark, sf))


@register("top_products", O.on_silver("""
SELECT producto, count(*) AS total_quejas FROM silver GROUP BY producto
ORDER BY total_quejas DESC, producto LIMIT 15"""))
def q_top_products(spark, sf):
    return M.top_products(silver(spark, sf))


@register("top_n", O.on_silver("SELECT * FROM ranked_entity ORDER BY ranking_quejas LIMIT 10",
                               O.ENTITY, _RANKED_ENTITY))
def q_top_n(spark, sf):
    return M.top_n(entity(spark, sf), "ranking_quejas", 10)


@register("last_periods", O.on_silver("SELECT * FROM monthly ORDER BY fecha_queja DESC LIMIT 12", O.MONTHLY))
def q_last_periods(spark, sf):
    return T.last_periods(monthly(spark, sf))


@register("top_per_ranking", O.on_silver("SELECT * FROM rankings WHERE posicion <= 10", _RANKINGS))
def q_top_per_ranking(spark, sf):
    return R.top_per_ranking(R.rankings(silver(spark, sf)))


@register("layer_row_counts", O.on_silver("""
SELECT 'quejas_financieras_raw' AS tabla, count(*) AS registros FROM raw
UNION ALL SELECT 'quejas_limpias', count(*) FROM silver
UNION ALL SELECT 'quejas_rechazadas', (SELECT count(*) FROM raw) - (SELECT count(*) FROM silver)
UNION ALL SELECT 'metricas_por_entidad', count(*) FROM entity
UNION ALL SELECT 'metricas_por_producto', count(DISTINCT producto) FROM silver
UNION ALL SELECT 'metricas_temporales', count(DISTINCT fecha_queja) FROM silver
UNION ALL SELECT 'ranking_entidades', count(*) FROM rankings
UNION ALL SELECT 'dashboard_kpis', 6""", O.ENTITY, _RANKINGS))
def q_layer_row_counts(spark, sf):
    from medalla.plans.medallion import build_layers, scratch_root
    from medalla.sources.layers import layer_row_counts, read_layer

    paths = build_layers(spark, raw_from_star(spark, sf), scratch_root(spark, "layers"), stamp=True)
    return layer_row_counts({name: read_layer(spark, path=p) for name, p in paths.items()}) \
        .select("tabla", "registros")


@register("read_raw_csv", O.on_raw("SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM raw"))
def q_read_raw_csv(spark, sf):
    from medalla.plans.medallion import scratch_root
    from medalla.sources.layers import read_raw_csv

    path = scratch_root(spark, "raw-csv")
    (raw(spark, sf).write.mode("overwrite").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_raw_csv(spark, path)


@register("write_layer", O.on_silver("SELECT * FROM silver"))
def q_write_layer(spark, sf):
    from medalla.plans.medallion import scratch_root
    from medalla.sources.layers import read_layer, write_layer

    path = scratch_root(spark, "silver-by-year")
    write_layer(C.conform(raw(spark, sf)), path=path, partition_by=["anio"])
    return read_layer(spark, path=path)


# ================================================================== series
@register("moving_average", O.on_silver("""
SELECT fecha_queja, total_quejas, promedio_movil_3meses FROM monthly""", O.MONTHLY))
def q_moving_average(spark, sf):
    base = M.monthly_base(silver(spark, sf))
    return T.moving_average(base, "total_quejas", "fecha_queja", 3, "promedio_movil_3meses") \
        .select("fecha_queja", "total_quejas", "promedio_movil_3meses")


@register("moving_average_events", f"""
WITH d AS (SELECT event_type, CAST(ts AS DATE) AS dia, count(*) AS eventos FROM events GROUP BY 1, 2)
SELECT event_type, dia, eventos,
  {r2('avg(eventos) OVER (PARTITION BY event_type ORDER BY dia ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)')} AS media_7d
FROM d""")
def q_moving_average_events(spark, sf):
    ev = read_table(spark, sf, "events")
    d = ev.groupBy("event_type", F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("eventos"))
    return T.moving_average(d, "eventos", "dia", 7, "media_7d", partition_by=["event_type"])


@register("trend_label", O.on_silver("SELECT fecha_queja, total_quejas, tendencia FROM monthly", O.MONTHLY))
def q_trend_label(spark, sf):
    base = M.monthly_base(silver(spark, sf))
    return T.with_trend(base, "total_quejas", "fecha_queja").select("fecha_queja", "total_quejas", "tendencia")


@register("centered_moving_average", O.on_silver(f"""
SELECT fecha_queja, total_quejas,
  CASE WHEN count(total_quejas) OVER w = 12 THEN {r6('avg(total_quejas) OVER w')} END AS media_movil_12
FROM monthly WINDOW w AS (ORDER BY fecha_queja ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)""", O.MONTHLY))
def q_centered_moving_average(spark, sf):
    base = M.monthly_base(silver(spark, sf)).select("fecha_queja", "total_quejas")
    out = T.centered_moving_average(base, "total_quejas", "fecha_queja", 12, "media_movil_12")
    return out.withColumn("media_movil_12", F.round("media_movil_12", 6))


@register("yearly_series_stats", O.on_silver(f"""
SELECT CAST(year(fecha_queja) AS INTEGER) AS anio, {r6('avg(total_quejas)')} AS media,
  {r6('stddev_samp(total_quejas)')} AS desviacion, min(total_quejas) AS minimo, max(total_quejas) AS maximo
FROM monthly GROUP BY 1""", O.MONTHLY))
def q_yearly_series_stats(spark, sf):
    return T.yearly_series_stats(monthly(spark, sf))


@register("series_span", O.on_silver("""
SELECT min(fecha_queja) AS fecha_inicial, max(fecha_queja) AS fecha_final, count(*) AS observaciones
FROM monthly""", O.MONTHLY))
def q_series_span(spark, sf):
    return T.series_span(monthly(spark, sf))


@register("series_points", O.on_silver("""
SELECT fecha_queja, total_quejas, promedio_movil_3meses FROM monthly""", O.MONTHLY))
def q_series_points(spark, sf):
    return monthly(spark, sf).select("fecha_queja", "total_quejas", "promedio_movil_3meses")


@register("forecast_mean", O.on_silver(f"""
SELECT CAST(paso AS INTEGER) AS paso, CAST(d + to_months(CAST(paso AS INTEGER)) AS DATE) AS fecha_pronostico,
  strftime(d + to_months(CAST(paso AS INTEGER)), '%Y-%m') AS periodo_mes,
  {r6('m')} AS prediccion, {r6('m - 1.96e0 * s')} AS intervalo_inferior, {r6('m + 1.96e0 * s')} AS intervalo_superior
FROM st, range(1, 4) AS t(paso)""", O.MONTHLY, """last6 AS (
  SELECT fecha_queja, total_quejas FROM monthly ORDER BY fecha_queja DESC LIMIT 6),
st AS (SELECT avg(total_quejas) AS m, stddev_samp(total_quejas) AS s, max(fecha_queja) AS d FROM last6)"""))
def q_forecast_mean(spark, sf):
    return T.forecast_mean(monthly(spark, sf))


@register("fill_calendar", O.on_silver("""
SELECT c.nombre_entidad, c.fecha_queja, coalesce(m.total_quejas, 0) AS total_quejas
FROM cal c LEFT JOIN m ON c.nombre_entidad IS NOT DISTINCT FROM m.nombre_entidad AND c.fecha_queja = m.fecha_queja""", """m AS (
  SELECT nombre_entidad, fecha_queja, count(*) AS total_quejas FROM silver GROUP BY 1, 2),
span AS (SELECT nombre_entidad, min(fecha_queja) AS a, max(fecha_queja) AS b FROM m GROUP BY 1),
cal AS (
  SELECT nombre_entidad, CAST(g AS DATE) AS fecha_queja
  FROM span, LATERAL (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 MONTH)) AS g))"""))
def q_fill_calendar(spark, sf):
    per = silver(spark, sf).groupBy("nombre_entidad", "fecha_queja").agg(F.count(F.lit(1)).alias("total_quejas"))
    return T.fill_calendar(per, ["total_quejas"], "fecha_queja", partition_by=["nombre_entidad"])


@register("seasonal_profile", O.on_silver(f"""
SELECT CAST(month(fecha_queja) AS INTEGER) AS mes, {r6('avg(total_quejas)')} AS media_mes, count(*) AS observaciones,
  {O.r2('avg(total_quejas) / (SELECT avg(total_quejas) FROM monthly)', 4)} AS indice_estacional
FROM monthly GROUP BY 1""", O.MONTHLY))
def q_seasonal_profile(spark, sf):
    return T.seasonal_profile(monthly(spark, sf))


_ANOM_Z = ("CASE WHEN count(total_quejas) OVER w >= 2 AND stddev_samp(total_quejas) OVER w > 0 "
           "THEN (total_quejas - avg(total_quejas) OVER w) / stddev_samp(total_quejas) OVER w END")


@register("series_anomalies", O.on_silver(f"""
SELECT fecha_queja, total_quejas, {r6('avg(total_quejas) OVER w')} AS media_previa, {r6(_ANOM_Z)} AS z,
  coalesce(abs({_ANOM_Z}) > 2, false) AS anomalia
FROM (SELECT fecha_queja, total_quejas FROM monthly) s
WINDOW w AS (ORDER BY fecha_queja ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)""", O.MONTHLY))
def q_series_anomalies(spark, sf):
    base = M.monthly_base(silver(spark, sf)).select("fecha_queja", "total_quejas")
    return T.series_anomalies(base)


# ===================================================================== EDA
#: exact mean: decimal sum (order independent) over the count
_EXACT_MEAN = "sum(CAST(valor AS DECIMAL(38, 10))) / count(valor)"
_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS metrica, CAST({c} AS DOUBLE) AS valor FROM entity" for c in ENTITY_FEATURES) + ")"


@register("describe_metrics", O.on_silver(f"""
SELECT metrica, count(valor) AS conteo, {r6(_EXACT_MEAN)} AS media, {r6('stddev_samp(valor)')} AS desviacion,
  min(valor) AS minimo, {r6('quantile_cont(valor, 0.25)')} AS p25, {r6('quantile_cont(valor, 0.5)')} AS p50,
  {r6('quantile_cont(valor, 0.75)')} AS p75, max(valor) AS maximo
FROM long GROUP BY metrica""", O.ENTITY, _LONG))
def q_describe_metrics(spark, sf):
    return E.describe_metrics(entity(spark, sf))


@register("key_percentiles", O.on_silver("\nUNION ALL\n".join(
    f"SELECT '{c}' AS metrica, CAST({p} AS DOUBLE) AS percentil, "
    f"{r6(f'quantile_cont(CAST({c} AS DOUBLE), {p})')} AS valor FROM entity"
    for c in ("total_quejas", "promedio_quejas_por_mes") for p in ("0.75", "0.9", "0.95")), O.ENTITY))
def q_key_percentiles(spark, sf):
    return E.key_percentiles(entity(spark, sf))


def _hist_sql(source_cte: str) -> str:
    return f"""
WITH {source_cte},
r AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
             CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM vals),
c AS (SELECT least(CAST(floor((v - lo) * 50 / (hi - lo)) AS INTEGER), 49) AS bin, count(*) AS f
      FROM vals, r WHERE v IS NOT NULL GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(50))
SELECT g.bin, {r6('lo + g.bin * ((hi - lo) / 50)')} AS limite_inferior,
  {r6('CASE WHEN g.bin = 49 THEN hi ELSE lo + (g.bin + 1) * ((hi - lo) / 50) END')} AS limite_superior,
  coalesce(c.f, 0) AS frecuencia,
  CASE WHEN coalesce(c.f, 0) > 0 THEN {r6('log10(c.f)')} END AS log10_frecuencia
FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin"""


@register("histogram", _hist_sql(
    f"{O.RAW}, {O.PARSED}, {O.SILVER}, {O.ENTITY}, vals AS (SELECT CAST(total_quejas AS DOUBLE) AS v FROM entity)"))
def q_histogram(spark, sf):
    return E.histogram(entity(spark, sf), "total_quejas", 50)


@register("histogram_lineitem", _hist_sql("vals AS (SELECT CAST(l_extendedprice AS DOUBLE) AS v FROM lineitem)"))
def q_histogram_lineitem(spark, sf):
    return E.histogram(read_table(spark, sf, "lineitem"), "l_extendedprice", 50)


@register("percentiles_lineitem", "\nUNION ALL\n".join(
    f"SELECT l_returnflag AS metrica, CAST({p} AS DOUBLE) AS percentil, "
    f"{r6(f'quantile_cont(l_extendedprice, {p})')} AS valor FROM lineitem GROUP BY l_returnflag"
    for p in ("0.25", "0.5", "0.75", "0.9", "0.95")))
def q_percentiles_lineitem(spark, sf):
    from medalla.operators.ordering import exact_quantiles

    q = exact_quantiles(read_table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice",
                        (0.25, 0.5, 0.75, 0.9, 0.95))
    return q.select(F.col("l_returnflag").alias("metrica"), F.col("p").alias("percentil"),
                    F.round("value", 6).alias("valor"))


@register("correlations", O.on_silver("\nUNION ALL\n".join(
    f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, "
    f"{r6(f'covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)')} AS correlacion FROM entity"
    for a, b in combinations(ENTITY_FEATURES, 2)), O.ENTITY))
def q_correlations(spark, sf):
    return E.correlations(entity(spark, sf))


@register("entity_features", O.on_silver(f"""
SELECT {_EKEYS}, {', '.join(ENTITY_FEATURES)} FROM entity
WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ENTITY_FEATURES)}""", O.ENTITY))
def q_entity_features(spark, sf):
    return G.entity_features(entity(spark, sf))


@register("standardize", O.on_silver(f"""
SELECT {_EKEYS}, """ + ", ".join(
    f"CASE WHEN coalesce(stddev_samp({c}) OVER (), 0) = 0 THEN 0e0 "
    f"ELSE {r6(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()')} END AS {c}_z"
    for c in ENTITY_FEATURES) + " FROM entity", O.ENTITY))
def q_standardize(spark, sf):
    return G.standardize(G.entity_features(entity(spark, sf)), keep=ENTITY_KEYS)


@register("nearest_peers", O.on_silver(f"""
SELECT {', '.join(f'a.{c}' for c in ENTITY_KEYS)}, {', '.join(f'b.{c} AS vecino_{c}' for c in ENTITY_KEYS)},
  CAST(row_number() OVER w AS INTEGER) AS posicion,
  {r6('sqrt(' + ' + '.join(f'pow(a.{c}_z - b.{c}_z, 2)' for c in ENTITY_FEATURES) + ')')} AS distancia
FROM z a JOIN z b ON a.id <> b.id
WINDOW w AS (PARTITION BY a.id ORDER BY {' + '.join(f'pow(a.{c}_z - b.{c}_z, 2)' for c in ENTITY_FEATURES)},
  {', '.join(f'b.{c} NULLS FIRST' for c in ENTITY_KEYS)})
QUALIFY posicion <= 5""", O.ENTITY, f"""z AS (SELECT row_number() OVER () AS id, {_EKEYS}, """ + ", ".join(
    f"CASE WHEN coalesce(stddev_samp({c}) OVER (), 0) = 0 THEN 0e0 "
    f"ELSE {r6(f'({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER ()')} END AS {c}_z"
    for c in ENTITY_FEATURES) + " FROM entity)"))
def q_nearest_peers(spark, sf):
    return N.nearest_peers(entity(spark, sf))


# ============================================================ segmentation
def _segmented(spark, sf):
    """The written segmentation layer (one K-Means fit per session)."""
    return segments_layer(spark, sf)


@register("segment_entities")
def q_segment_entities(spark, sf):
    return G.clustering_table(G.segment_entities(entity(spark, sf)))


@register("clustering_table")
def q_clustering_table(spark, sf):
    return G.clustering_table(_segmented(spark, sf))


@register("cluster_profile")
def q_cluster_profile(spark, sf):
    return G.cluster_profile(_segmented(spark, sf))


@register("cluster_examples")
def q_cluster_examples(spark, sf):
    return G.cluster_examples(_segmented(spark, sf))


@register("cluster_centers")
def q_cluster_centers(spark, sf):
    return G.cluster_centers(_segmented(spark, sf))


@register("cluster_quality")
def q_cluster_quality(spark, sf):
    return G.cluster_quality(_segmented(spark, sf))


@register("peer_benchmark_cluster")
def q_peer_benchmark_cluster(spark, sf):
    """Each entity against the others of its K-Means cluster."""
    return G.peer_benchmark(_segmented(spark, sf), "cluster")


@register("segment_checks", O.on_silver("""
SELECT 'entidades' AS control, count(*) AS valor FROM entity
UNION ALL SELECT 'lejos_de_su_centro', 0 UNION ALL SELECT 'fuera_de_orden', 0 UNION ALL SELECT 'etiqueta_equivocada', 0
UNION ALL SELECT 'ejemplos_equivocados', 0 UNION ALL SELECT 'silueta_igual', 1""", O.ENTITY))
def q_segment_checks(spark, sf):
    return G.segment_checks(_segmented(spark, sf))


@register("cluster_points")
def q_cluster_points(spark, sf):
    return G.cluster_points(_segmented(spark, sf))


@register("select_k")
def q_select_k(spark, sf):
    return G.select_k(entity(spark, sf))


# ======================================================= announced analyses
@register("volume_band", O.on_silver(f"""
SELECT {_EKEYS}, total_quejas,
  CASE WHEN total_quejas < 50 THEN 'Bajo Volumen' WHEN total_quejas < 500 THEN 'Volumen Medio'
       WHEN total_quejas <= 2000 THEN 'Alto Volumen' ELSE 'Volumen Crítico' END AS banda_volumen
FROM entity""", O.ENTITY))
def q_volume_band(spark, sf):
    return G.with_volume_band(entity(spark, sf)).select(*ENTITY_KEYS, "total_quejas", "banda_volumen")


_PARETO = f"""pareto AS (
  SELECT {_EKEYS}, total_quejas,
    CAST(sum(total_quejas) OVER o AS BIGINT) AS acumulado,
    CAST(row_number() OVER o AS BIGINT) AS posicion,
    {O.r2('sum(total_quejas) OVER o * 100e0 / (SELECT sum(total_quejas) FROM entity)', 4)} AS porcentaje_acumulado,
    {O.r2('row_number() OVER o * 100e0 / (SELECT count(*) FROM entity)', 4)} AS porcentaje_entidades
  FROM entity
  WINDOW o AS (ORDER BY total_quejas DESC, {_EKEYS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@register("pareto", O.on_silver("SELECT * FROM pareto", O.ENTITY, _PARETO))
def q_pareto(spark, sf):
    return A.pareto(entity(spark, sf))


@register("pareto_summary", O.on_silver("""
SELECT n AS entidades, top AS entidades_top, CAST(20 AS INTEGER) AS porcentaje_entidades_top,
  p.porcentaje_acumulado AS porcentaje_quejas_top
FROM (SELECT count(*) AS n, CAST((count(*) * 20 + 99) // 100 AS BIGINT) AS top FROM entity) k
JOIN pareto p ON p.posicion = k.top""", O.ENTITY, _PARETO))
def q_pareto_summary(spark, sf):
    return A.pareto_summary(entity(spark, sf))


@register("pivot_counts", O.on_silver("""
SELECT tipo_entidad_desc, count(*) FILTER (WHERE estado = 'VIGENTES') AS VIGENTES,
  count(*) FILTER (WHERE estado = 'RECIBIDOS') AS RECIBIDOS, count(*) FILTER (WHERE estado = 'CERRADOS') AS CERRADOS,
  count(*) FILTER (WHERE coalesce(estado NOT IN ('VIGENTES', 'RECIBIDOS', 'CERRADOS'), true)) AS otros
FROM silver GROUP BY tipo_entidad_desc"""))
def q_pivot_counts(spark, sf):
    return A.pivot_counts(silver(spark, sf), "tipo_entidad_desc", "estado", ["VIGENTES", "RECIBIDOS", "CERRADOS"])


@register("pivot_orders", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
  count(*) FILTER (WHERE coalesce(o_orderstatus NOT IN ('O', 'F'), true)) AS otros
FROM orders GROUP BY o_orderpriority""")
def q_pivot_orders(spark, sf):
    return A.pivot_counts(read_table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["O", "F"])


@register("share_by_orders", f"""
SELECT o_orderpriority, count(*) AS filas, count(DISTINCT o_custkey) AS clientes,
  {r2('count(*) * 100e0 / sum(count(*)) OVER ()')} AS porcentaje
FROM orders GROUP BY o_orderpriority""")
def q_share_by_orders(spark, sf):
    return M.share_by(read_table(spark, sf, "orders"), "o_orderpriority", "o_custkey",
                      count_name="filas", entities_name="clientes")


@register("lift", O.on_silver(f"""
SELECT producto, tipo_entidad_desc, quejas,
  {O.r2('(CAST(quejas AS DOUBLE) / g) * 100e0', 4)} AS participacion_en_grupo,
  {O.r2('(CAST(i AS DOUBLE) / t) * 100e0', 4)} AS participacion_total,
  {O.r2('(CAST(quejas AS DOUBLE) / g) / (CAST(i AS DOUBLE) / t)', 4)} AS lift
FROM (
  SELECT producto, tipo_entidad_desc, quejas,
    sum(quejas) OVER (PARTITION BY tipo_entidad_desc) AS g,
    sum(quejas) OVER (PARTITION BY producto) AS i,
    sum(quejas) OVER () AS t
  FROM (SELECT producto, tipo_entidad_desc, count(*) AS quejas FROM silver GROUP BY 1, 2) c
) x"""))
def q_lift(spark, sf):
    return A.lift(silver(spark, sf))


_NORMAL_TAIL = ("exp(-z * z / 2) / sqrt(2 * pi()) * (" + " + ".join(
    f"{b!r} * pow(1 / (1 + {I.TAIL_SCALE!r} * abs(z)), {i})" for i, b in enumerate(I.TAIL, 1)) + ")")


@register("tested_lift", O.on_silver(f"""
SELECT motivo, nombre_entidad, quejas, {O.r2('e', 4)} AS esperadas, {O.r2('quejas / e', 4)} AS lift,
  {O.r2('(quejas * s + 1) / (e * s + 1)', 4)} AS lift_ajustado, {O.r2('z', 4)} AS z, {r6('p')} AS p, {r6('q')} AS q,
  q <= 0.05e0 AS significativo
FROM (
  SELECT *, least(1e0, min(p * m / k) OVER (ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS q
  FROM (SELECT *, row_number() OVER (ORDER BY p, motivo, nombre_entidad) AS k, count(*) OVER () AS m
    FROM (SELECT *, least(1e0, 2 * {_NORMAL_TAIL}) AS p
      FROM (SELECT *, 2 * (sqrt(quejas) - sqrt(e)) AS z,
          greatest(0e0, sum((quejas - e) * (quejas - e) - e) OVER () / sum(e * e) OVER ()) AS s
        FROM (SELECT motivo, nombre_entidad, quejas,
            CAST(sum(quejas) OVER (PARTITION BY nombre_entidad) AS DOUBLE) * sum(quejas) OVER (PARTITION BY motivo)
              / sum(quejas) OVER () AS e
          FROM (SELECT motivo, nombre_entidad, count(*) AS quejas FROM silver GROUP BY 1, 2) c) x) y) t) r) f"""))
def q_tested_lift(spark, sf):
    return I.tested_lift(silver(spark, sf))


_REPLICAS = f"""drawn AS (
  SELECT b AS replica, {_EKEYS}, total_quejas AS v,
    CASE WHEN b = 0 THEN 1 ELSE {' + '.join(f'(u >= {x})::BIGINT' for x in I.POISSON_STEPS)} END AS w
  FROM (SELECT *, CAST('0x' || substr(md5(concat_ws('|', 1, b, {', '.join(f'CAST({k} AS VARCHAR)' for k in ENTITY_KEYS)})), 1, 8)
      AS BIGINT) AS u FROM entity, range(0, 201) AS t(b))),
running AS (
  SELECT *, sum(w) OVER o AS cw, sum(w * v) OVER o AS cs,
    sum(w) OVER (PARTITION BY replica) AS tw, sum(w * v) OVER (PARTITION BY replica) AS ts
  FROM drawn WINDOW o AS (PARTITION BY replica ORDER BY v DESC, {_EKEYS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
replicas AS (
  SELECT CAST(replica AS INTEGER) AS replica, CAST(max(tw) AS BIGINT) AS entidades, CAST(max(ts) AS BIGINT) AS quejas,
    {r6('CAST(sum(w * (2 * cs - w * v)) AS DOUBLE) / max(tw) / max(ts) - 1')} AS gini,
    {r6('CAST(sum(greatest(0, least(100 * w, 20 * tw - 100 * (cw - w))) * v) AS DOUBLE) / max(ts)')} AS participacion_top
  FROM running GROUP BY 1)"""


@register("concentration_replicates", O.on_silver("SELECT * FROM replicas", O.ENTITY, _REPLICAS))
def q_concentration_replicates(spark, sf):
    return I.concentration_replicates(entity(spark, sf))


@register("concentration", O.on_silver(f"""
SELECT count(*) FILTER (WHERE replica > 0) AS replicas, {', '.join(
    f"max({c}) FILTER (WHERE replica = 0) AS {c}, " + ', '.join(
        f"{r6(f'quantile_cont({c}, {x}) FILTER (WHERE replica > 0)')} AS {c}_{name}"
        for x, name in ((0.05, 'inferior'), (0.95, 'superior'))) for c in ('gini', 'participacion_top'))}
FROM replicas""", O.ENTITY, _REPLICAS))
def q_concentration(spark, sf):
    return I.concentration(I.concentration_replicates(entity(spark, sf)))


@register("peer_benchmark", O.on_silver(f"""
SELECT tipo_entidad_desc, codigo_entidad, nombre_entidad, total_quejas,
  {O.r2('avg(total_quejas) OVER (PARTITION BY tipo_entidad_desc)', 4)} AS media_grupo,
  count(*) OVER (PARTITION BY tipo_entidad_desc) AS pares,
  {O.r2('total_quejas / avg(total_quejas) OVER (PARTITION BY tipo_entidad_desc)', 4)} AS indice_vs_pares
FROM entity""", O.ENTITY))
def q_peer_benchmark(spark, sf):
    return G.peer_benchmark(entity(spark, sf))


@register("entity_drilldown", O.on_silver(f"""
SELECT (SELECT nombre_entidad FROM tgt) AS nombre_entidad, mk.fecha_queja, mk.periodo_mes,
  coalesce(own.q, 0) AS quejas_entidad, mk.quejas_mercado,
  {r2('coalesce(own.q, 0) * 100e0 / mk.quejas_mercado')} AS participacion
FROM mk LEFT JOIN own ON mk.fecha_queja = own.fecha_queja AND mk.periodo_mes = own.periodo_mes""", """tgt AS (
  SELECT nombre_entidad FROM silver GROUP BY nombre_entidad ORDER BY count(*) DESC, nombre_entidad LIMIT 1),
mk AS (SELECT fecha_queja, periodo_mes, count(*) AS quejas_mercado FROM silver GROUP BY 1, 2),
own AS (SELECT fecha_queja, periodo_mes, count(*) AS q FROM silver
        WHERE nombre_entidad = (SELECT nombre_entidad FROM tgt) GROUP BY 1, 2)"""))
def q_entity_drilldown(spark, sf):
    return A.entity_drilldown(silver(spark, sf))


@register("entity_products", O.on_silver(f"""
SELECT nombre_entidad, c.producto, q AS quejas_entidad, m AS quejas_mercado,
  {r2('q * 100e0 / m')} AS participacion_en_producto, {r2('q * 100e0 / sum(q) OVER ()')} AS participacion_en_entidad
FROM c JOIN (SELECT producto, CAST(sum(q) AS BIGINT) AS m FROM c GROUP BY producto) p USING (producto)
WHERE nombre_entidad = (SELECT nombre_entidad FROM tgt)""", """tgt AS (
  SELECT nombre_entidad FROM silver GROUP BY nombre_entidad ORDER BY count(*) DESC, nombre_entidad LIMIT 1),
c AS (SELECT nombre_entidad, producto, count(*) AS q FROM silver GROUP BY 1, 2)"""))
def q_entity_products(spark, sf):
    return A.entity_products(silver(spark, sf))


@register("yearly_features", O.on_silver(f"""
SELECT {_EKEYS}, anio, count(*) AS total_quejas, count(DISTINCT producto) AS productos_distintos,
  count(DISTINCT motivo) AS motivos_distintos, count(DISTINCT periodo_mes) AS meses_con_quejas,
  {r2('count(*) / count(DISTINCT periodo_mes)')} AS promedio_quejas_por_mes
FROM silver GROUP BY {_EKEYS}, anio"""))
def q_yearly_features(spark, sf):
    return G.yearly_features(silver(spark, sf))


@register("catalog_roundtrip", O.on_silver("SELECT * FROM silver"))
def q_catalog_roundtrip(spark, sf):
    """Silver saved as a catalog table of a new database and read by name."""
    from medalla.plans.medallion import scratch_root
    from medalla.schema import SILVER_SCHEMA
    from medalla.sources.layers import read_layer, write_layer

    place = scratch_root(spark, "catalog")
    db = "medalla_" + place.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{place}'")
    write_layer(C.conform(raw(spark, sf)), table=f"{db}.quejas_limpias", partition_by=["anio"], schema=SILVER_SCHEMA)
    return read_layer(spark, table=f"{db}.quejas_limpias")


@register("band_transitions", O.on_silver("""
SELECT banda_origen, banda AS banda_destino, count(*) AS transiciones
FROM (
  SELECT banda, lag(banda) OVER (PARTITION BY nombre_entidad ORDER BY anio) AS banda_origen,
    anio - lag(anio) OVER (PARTITION BY nombre_entidad ORDER BY anio) AS salto
  FROM (
    SELECT nombre_entidad, anio,
      CASE WHEN count(*) < 50 THEN 'Bajo Volumen' WHEN count(*) < 500 THEN 'Volumen Medio'
           WHEN count(*) <= 2000 THEN 'Alto Volumen' ELSE 'Volumen Crítico' END AS banda
    FROM silver GROUP BY nombre_entidad, anio) y) t
WHERE salto = 1
GROUP BY 1, 2"""))
def q_band_transitions(spark, sf):
    return G.band_transitions(silver(spark, sf))


# ==================================================================== text
def _terms_sql(source: str, text: str, group: str, k: int) -> str:
    stops = ", ".join(f"'{w}'" for w in X.STOP_WORDS)
    return f"""t AS (
  SELECT {group}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS termino FROM {source}),
c AS (SELECT {group}, termino, count(*) AS frecuencia FROM t
      WHERE length(termino) >= 2 AND termino NOT IN ({stops}) GROUP BY 1, 2),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY {group} ORDER BY frecuencia DESC, termino) AS INTEGER)
             AS posicion FROM c)"""


@register("reason_terms", O.on_silver("SELECT * FROM ranked WHERE posicion <= 5",
                                      _terms_sql("silver", "motivo", "producto", 5)))
def q_reason_terms(spark, sf):
    return X.term_counts(silver(spark, sf), "motivo", "producto", 5)


@register("document_terms", O.with_ctes("SELECT * FROM ranked WHERE posicion <= 20",
                                        _terms_sql("documents", "text", "lang", 20)))
def q_document_terms(spark, sf):
    return X.term_counts(read_table(spark, sf, "documents"), "text", "lang", 20)


# ========================================================== the count cube
def cube(spark, sf) -> DataFrame:
    """The written count cube of silver, as gold tables read it."""
    return cube_layer(spark, sf)


_CUBE = f"SELECT {', '.join(K.DIMS)}, count(*) AS quejas FROM silver GROUP BY ALL"


@register("count_cube", O.on_silver(_CUBE))
def q_count_cube(spark, sf):
    return K.count_cube(silver(spark, sf))


@register("merge_cubes", O.on_silver(_CUBE))
def q_merge_cubes(spark, sf):
    """Cubes of two loads add up to that of both."""
    s = silver(spark, sf)
    odd = F.col("anio") % 2 == 1
    return K.merge_cubes([K.count_cube(s.where(odd)), K.count_cube(s.where(~odd))])


def _register_gold(name: str, table: str) -> None:
    """The gold table ``table`` from the cube: the same SQL as from silver."""
    @register(f"{name}_cube", SQL[name])
    def query(spark, sf):
        return K.gold_tables(cube(spark, sf))[table]()


for _name, _table in {"entity_metrics": "metricas_por_entidad", "product_metrics": "metricas_por_producto",
                      "monthly_metrics": "metricas_temporales", "rankings": "ranking_entidades", "kpi_table": "dashboard_kpis"}.items():
    _register_gold(_name, _table)


_SKETCHED = ("nombre_entidad", "producto", "motivo")


@register("distinct_rollup", O.on_silver(f"""
SELECT anio, count(*) AS quejas, {', '.join(f'count(DISTINCT {c}) AS {c}_exacto, true AS {c}_dentro' for c in _SKETCHED)}
FROM silver GROUP BY anio"""))
def q_distinct_rollup(spark, sf):
    """Distinct values per year from the sketches of its months, next to the
    exact counts: within four standard errors."""
    sketches = K.distinct_sketches(cube(spark, sf), ["anio", "periodo_mes"], _SKETCHED)
    rough = K.merge_sketches(sketches, ["anio"], _SKETCHED)
    exact = cube(spark, sf).groupBy("anio").agg(*[F.countDistinct(c).alias(f"{c}_exacto") for c in _SKETCHED])
    error = 4 * 1.04 / 2 ** (K.LG_K / 2)
    return rough.join(exact, "anio").select("anio", "quejas", *[x for c in _SKETCHED for x in (F.col(f"{c}_exacto"), (
        F.abs(F.col(f"{c}_aprox") - F.col(f"{c}_exacto")) <= error * F.col(f"{c}_exacto") + 0.5).alias(f"{c}_dentro"))])


# ======================================================= incremental loads
def _landed(spark, sf) -> tuple:
    """Bronze landed in three goes, the last of two years only."""
    from medalla.plans.incremental import IncrementalLayers
    from medalla.plans.medallion import scratch_root

    root = scratch_root(spark, "incremental")
    bronze = raw(spark, sf)
    part = F.pmod(F.xxhash64("NOMBRE_ENTIDAD", "PRODUCTO", "MOTIVO"), F.lit(4))
    recent = F.coalesce(F.col("ANIO").isin("1.997", "1.998"), F.lit(False))

    def land(rows: DataFrame, name: str) -> None:
        rows.write.parquet(f"{root}/landing/{name}")

    layers = IncrementalLayers(spark, f"{root}/landing", f"{root}/layers")
    out = []
    land(bronze.where(~recent & (part < 2)), "a")
    out.append(layers.refresh(gold=False))
    land(bronze.where(~recent & (part >= 2)), "b")
    out.append(layers.refresh(gold=False))
    land(bronze.where(recent), "c")
    out.append(layers.refresh())
    return layers, out, root


@register("incremental_refresh", SQL["entity_metrics"])
def q_incremental_refresh(spark, sf):
    """The entity mart after three loads is that of one full build."""
    _, _, root = _landed(spark, sf)
    return spark.read.parquet(f"{root}/layers/metricas_por_entidad")


@register("refresh_report", O.on_silver("""
SELECT lote, count(DISTINCT anio) AS anios FROM (
  SELECT anio, unnest(CASE WHEN anio IN (1997, 1998) THEN [3] ELSE [1, 2] END) AS lote FROM silver) GROUP BY lote"""))
def q_refresh_report(spark, sf):
    """Years that each load recounted."""
    _, loads, _ = _landed(spark, sf)
    return spark.createDataFrame([(r["lote"], len(r["anios"])) for r in loads], "lote int, anios long")


# ================================================= patterns between values
def _sets_sql(columns, support: float) -> str:
    """Counts of every combination of the attributes' values."""
    parts = []
    for k in range(1, len(columns) + 1):
        for some in combinations(columns, k):
            items = ", ".join(f"'{c}=' || {c}" for c in some)
            parts.append(f"SELECT list_sort([{items}]) AS items, count(*) AS n FROM silver "
                         f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in some)} GROUP BY {', '.join(some)}")
    return (f"sets AS (SELECT *, (SELECT count(*) FROM silver) AS total FROM ({' UNION ALL '.join(parts)}) "
            f"WHERE n >= ceil({support} * (SELECT count(*) FROM silver)))")


@register("frequent_sets", O.on_silver("""
SELECT array_to_string(items, ' & ') AS conjunto, CAST(len(items) AS INTEGER) AS elementos, n AS quejas FROM sets""",
                                       _sets_sql(P.ATTRIBUTES, 0.05)))
def q_frequent_sets(spark, sf):
    return P.frequent_sets(silver(spark, sf))


@register("association_rules", O.on_silver(f"""
SELECT array_to_string(a.items, ' & ') AS antecedente, one.items[1] AS consecuente, {r6('w.n * 1e0 / w.total')} AS soporte,
  {r6('w.n * 1e0 / a.n')} AS confianza, {r6('(w.n * 1e0 / a.n) / (one.n * 1e0 / w.total)')} AS lift
FROM (SELECT *, unnest(items) AS item FROM sets WHERE len(items) > 1) w
JOIN sets a ON a.items = list_filter(w.items, lambda x: x <> w.item) JOIN sets one ON one.items = [w.item]
WHERE w.n >= 0.3 * a.n""", _sets_sql(P.ATTRIBUTES, 0.05)))
def q_association_rules(spark, sf):
    return P.association_rules(silver(spark, sf))


# ===================================== seasonal forecasts and change points
def _monthly_by(spark, sf, *keys) -> DataFrame:
    return K.roll_up(cube(spark, sf), [*keys, "fecha_queja"])


_SERIES = """ends AS (SELECT tipo_entidad_desc AS k, min(fecha_queja) AS a, max(fecha_queja) AS b FROM silver GROUP BY 1),
months AS (SELECT k, a, b, unnest(generate_series(a, b, INTERVAL 1 MONTH))::DATE AS m FROM ends),
vals AS (SELECT months.k, months.m, CAST(coalesce(c.n, 0) AS DOUBLE) AS v FROM months LEFT JOIN (
  SELECT tipo_entidad_desc AS k, fecha_queja AS m, count(*) AS n FROM silver GROUP BY 1, 2) c
  ON c.k IS NOT DISTINCT FROM months.k AND c.m = months.m),
x AS (SELECT k, max(m) AS last, list(v ORDER BY m) AS x FROM vals GROUP BY k HAVING count(*) >= 24),
grid AS (SELECT * FROM (VALUES """ + ", ".join(f"({i}, {a}e0, {b}e0, {g}e0)" for i, (a, b, g) in enumerate(W.GRID)) + """) AS g(i, alfa, beta, gama)),
hw AS (
  SELECT k, i, 12 AS t, list_sum(x[1:12]) / 12 AS level, (list_sum(x[13:24]) / 12 - list_sum(x[1:12]) / 12) / 12 AS trend,
    list_transform(x[1:12], lambda v: v - list_sum(x[1:12]) / 12) AS season, 0e0 AS sse FROM x, grid
  UNION ALL
  SELECT k, i, t + 1, new_level, new_trend, list_append(season[2:12], gama * (v - new_level) + (1 - gama) * season[1]),
    sse + (v - (level + trend + season[1])) * (v - (level + trend + season[1]))
  FROM (SELECT *, beta * (new_level - level) + (1 - beta) * trend AS new_trend FROM (
    SELECT hw.*, x.x[t + 1] AS v, beta, gama, alfa * (x.x[t + 1] - season[1]) + (1 - alfa) * (level + trend) AS new_level
    FROM hw JOIN x ON x.k IS NOT DISTINCT FROM hw.k JOIN grid USING (i) WHERE t < len(x.x)))),
best AS (SELECT hw.*, x.last, x.x, row_number() OVER (PARTITION BY hw.k ORDER BY sse, i) AS r
  FROM hw JOIN x ON x.k IS NOT DISTINCT FROM hw.k WHERE t = len(x.x))"""


@register("seasonal_forecast", O.on_silver(f"""
SELECT k AS tipo_entidad_desc, CAST(paso AS INTEGER) AS paso, CAST(last + to_months(CAST(paso AS INTEGER)) AS DATE) AS fecha,
  {r6('level + paso * trend + season[paso]')} AS prediccion, alfa, beta, gama, {r6('sqrt(sse / (len(x) - 12))')} AS error_estacional,
  {r6('sqrt(list_sum(list_transform(range(13, len(x) + 1), lambda t: pow(x[t] - list_sum(x[t - 6:t - 1]) / 6, 2))) / (len(x) - 12))')} AS error_plano
FROM best JOIN grid USING (i), range(1, 4) AS p(paso) WHERE r = 1""", _SERIES).replace("WITH raw", "WITH RECURSIVE raw", 1))
def q_seasonal_forecast(spark, sf):
    return W.seasonal_forecast(_monthly_by(spark, sf, "tipo_entidad_desc"), ["tipo_entidad_desc"], "fecha_queja", "quejas")


@register("change_points")
def q_change_points(spark, sf):
    return W.change_points(_monthly_by(spark, sf, *ENTITY_KEYS), ENTITY_KEYS, "fecha_queja", "quejas")


@register("change_checks", O.on_silver("""
SELECT 'series' AS control, count(*) AS valor FROM e UNION ALL SELECT 'meses', CAST(sum(meses) AS BIGINT) FROM e
UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM e UNION ALL SELECT 'huecos', 0 UNION ALL SELECT 'totales_distintos', 0""", f"""e AS (
  SELECT datediff('month', min(fecha_queja), max(fecha_queja)) + 1 AS meses, count(*) AS n FROM silver GROUP BY {', '.join(ENTITY_KEYS)})"""))
def q_change_checks(spark, sf):
    m = _monthly_by(spark, sf, *ENTITY_KEYS)
    return W.change_checks(q_change_points(spark, sf), m, ENTITY_KEYS, "fecha_queja", "quejas")


# ====================================================== clusters over time
def evolution(spark, sf) -> tuple[DataFrame, DataFrame]:
    return V.cluster_evolution(silver(spark, sf))


_EY = f"ey AS (SELECT DISTINCT {', '.join(ENTITY_KEYS)}, anio FROM silver)"
_EY_ON = " AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in ENTITY_KEYS)


@register("evolution_checks", O.on_silver(f"""
SELECT 'entidades_anio' AS control, count(*) AS valor FROM ey
UNION ALL SELECT 'entidades_en_ambos_anios', count(*) FROM ey a JOIN ey b ON b.anio = a.anio + 1 AND {_EY_ON}
UNION ALL SELECT 'lejos_de_su_centro', 0
UNION ALL SELECT 'filas_sin_100', 0
UNION ALL SELECT 'emparejamientos_superados', 0""", _EY))
def q_evolution_checks(spark, sf):
    return V.evolution_checks(*evolution(spark, sf))


@register("cluster_transitions")
def q_cluster_transitions(spark, sf):
    return V.track_transitions(evolution(spark, sf)[0])


@register("cluster_tracks")
def q_cluster_tracks(spark, sf):
    return V.track_profile(*evolution(spark, sf))


# =============================================================== streaming
@register("monthly_counts_stream", f"""
SELECT make_date(year(ts), month(ts), 1) AS mes, event_type, count(*) AS eventos,
  {r6('sum(value)')} AS valor_total
FROM events GROUP BY 1, 2""")
def q_monthly_counts_stream(spark, sf):
    from medalla.plans.medallion import scratch_root
    from medalla.streaming.monthly import run_monthly_counts_stream

    root = scratch_root(spark, "stream")
    out = run_monthly_counts_stream(spark, sf, f"{root}/out", f"{root}/chk", file_glob="events.parquet")
    return out.withColumn("valor_total", F.round("valor_total", 6))


def _event_time_sql(rows: str, end: str, delay: str, keys: str) -> tuple[str, str]:
    """Body and CTEs; ``rows``: a query with ``arrival, periodo``, the keys."""
    ctes = f"""r AS (SELECT *, {end} AS cierre FROM ({rows})),
marks AS (SELECT arrival, max(max(cierre)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - INTERVAL '{delay}' AS mark, max(max(cierre)) OVER () - INTERVAL '{delay}' AS final FROM r GROUP BY arrival)"""
    return f"""
SELECT CASE WHEN mark IS NOT NULL AND cierre <= mark THEN 'tarde' WHEN cierre <= final THEN 'cerrado' ELSE 'abierto' END AS estado,
  CAST(periodo AS DATE) AS periodo, {keys}, count(*) AS eventos
FROM r JOIN marks USING (arrival) GROUP BY ALL""", ctes


def _event_time(spark, rows: DataFrame, ts: str, keys: list[str], folders, **kw) -> DataFrame:
    from medalla.plans.medallion import scratch_root
    from medalla.streaming.event_time import END, EventTimeCounts, _start, arrivals

    root = scratch_root(spark, "event-time")
    schema = rows.drop("arrival").schema
    spark.createDataFrame([], schema).write.parquet(f"{root}/landing")
    counts = EventTimeCounts(spark, f"{root}/landing", f"{root}/tables", schema, ts, keys, **kw)
    arrivals(counts, rows, "arrival", folders)
    late = counts.late().withColumn("periodo", _start(kw["unit"])).drop(END).groupBy("periodo", *keys).agg(
        F.count(F.lit(1)).alias("eventos"))
    parts = {"cerrado": counts.closed(), "tarde": late, "abierto": counts.open_periods()}
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("estado"), "periodo", *keys, "eventos") for name, df in parts.items()])


# a refresh every ten days; every 17th event lands ten days late
_EV_ARRIVAL = "CAST(day(ts) + CASE WHEN event_id % 17 = 0 THEN 10 ELSE 0 END AS INTEGER)"


@register("late_events_stream", O.with_ctes(*_event_time_sql(
    f"SELECT ({_EV_ARRIVAL} - 1) // 10 AS arrival, date_trunc('day', ts) AS periodo, event_type FROM events",
    "periodo + INTERVAL 1 DAY", "3 days", "event_type")))
def q_late_events_stream(spark, sf):
    rows = read_table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", F.floor((F.expr(_EV_ARRIVAL) - 1) / 10).alias("arrival"))
    return _event_time(spark, rows, "ts", ["event_type"], range(5), unit="day", delay="3 days")


# one refresh for every four years; every seventh entity sends the last quarters a refresh late
_CQ_ARRIVAL = "anio + CASE WHEN codigo_entidad % 7 = 0 AND mes > 9 THEN 4 ELSE 0 END"


@register("late_complaints_stream", O.on_silver(*_event_time_sql(
    f"SELECT CAST(floor(({_CQ_ARRIVAL} - 1992) / 4) AS INTEGER) AS arrival, fecha_queja AS periodo, tipo_entidad_desc FROM silver",
    "CAST(periodo AS TIMESTAMP) + INTERVAL 1 MONTH", "35 days", "tipo_entidad_desc")))
def q_late_complaints_stream(spark, sf):
    rows = silver(spark, sf).select(F.col("fecha_queja").cast("timestamp").alias("fecha"), "tipo_entidad_desc",
                                    F.floor((F.expr(_CQ_ARRIVAL) - 1992) / 4).alias("arrival"))
    return _event_time(spark, rows, "fecha", ["tipo_entidad_desc"], range(4), unit="month", delay="35 days")


# ======================================= generic operators on other tables
_LI_NUM = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@register("describe_lineitem", f"""
WITH long AS ({" UNION ALL ".join(f"SELECT '{c}' AS metrica, CAST({c} AS DOUBLE) AS valor FROM lineitem" for c in _LI_NUM)})
SELECT metrica, count(valor) AS conteo, {r6(_EXACT_MEAN)} AS media, {r6('stddev_samp(valor)')} AS desviacion,
  min(valor) AS minimo, {r6('quantile_cont(valor, 0.25)')} AS p25, {r6('quantile_cont(valor, 0.5)')} AS p50,
  {r6('quantile_cont(valor, 0.75)')} AS p75, max(valor) AS maximo
FROM long GROUP BY metrica""")
def q_describe_lineitem(spark, sf):
    return E.describe_metrics(read_table(spark, sf, "lineitem"), _LI_NUM)


@register("correlations_lineitem", "\nUNION ALL\n".join(
    f"SELECT '{a}' AS variable_a, '{b}' AS variable_b, "
    f"{r6(f'covar_samp({a}, {b}) / nullif(stddev_samp({a}) * stddev_samp({b}), 0)')} AS correlacion FROM lineitem"
    for a, b in combinations(_LI_NUM, 2)))
def q_correlations_lineitem(spark, sf):
    return E.correlations(read_table(spark, sf, "lineitem"), _LI_NUM)


_EV_DAILY = "d AS (SELECT CAST(ts AS DATE) AS dia, count(*) AS eventos FROM events GROUP BY 1)"
_EV_Z = ("CASE WHEN count(eventos) OVER w >= 2 AND stddev_samp(eventos) OVER w > 0 "
         "THEN (eventos - avg(eventos) OVER w) / stddev_samp(eventos) OVER w END")


@register("anomalies_events", f"""
WITH {_EV_DAILY}
SELECT dia, eventos, {r6('avg(eventos) OVER w')} AS media_previa, {r6(_EV_Z)} AS z,
  coalesce(abs({_EV_Z}) > 2, false) AS anomalia
FROM d WINDOW w AS (ORDER BY dia ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)""")
def q_anomalies_events(spark, sf):
    d = read_table(spark, sf, "events").groupBy(F.to_date("ts").alias("dia")).agg(F.count(F.lit(1)).alias("eventos"))
    return T.series_anomalies(d, "eventos", "dia")


@register("forecast_orders", f"""
WITH m AS (SELECT make_date(year(o_orderdate), month(o_orderdate), 1) AS mes, count(*) AS pedidos
           FROM orders GROUP BY 1),
last6 AS (SELECT * FROM m ORDER BY mes DESC LIMIT 6),
st AS (SELECT avg(pedidos) AS m, stddev_samp(pedidos) AS s, max(mes) AS d FROM last6)
SELECT CAST(paso AS INTEGER) AS paso, CAST(d + to_months(CAST(paso AS INTEGER)) AS DATE) AS fecha_pronostico,
  strftime(d + to_months(CAST(paso AS INTEGER)), '%Y-%m') AS periodo_mes,
  {r6('m')} AS prediccion, {r6('m - 1.96e0 * s')} AS intervalo_inferior, {r6('m + 1.96e0 * s')} AS intervalo_superior
FROM st, range(1, 4) AS t(paso)""")
def q_forecast_orders(spark, sf):
    o = read_table(spark, sf, "orders")
    m = o.groupBy(F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).alias("mes")) \
         .agg(F.count(F.lit(1)).alias("pedidos"))
    return T.forecast_mean(m, "pedidos", "mes")


@register("monthly_complaints_stream", O.on_silver("""
SELECT fecha_queja, tipo_entidad_desc, count(*) AS total_quejas FROM silver GROUP BY 1, 2"""))
def q_monthly_complaints_stream(spark, sf):
    from medalla.plans.layers import layer_path
    from medalla.plans.medallion import scratch_root
    from medalla.streaming.monthly import run_monthly_complaints_stream

    root = scratch_root(spark, "complaint-stream")
    return run_monthly_complaints_stream(spark, layer_path(spark, sf, "quejas_financieras_raw"),
                                         f"{root}/out", f"{root}/chk")
