"""Independent SQL statements of every registered query, for DuckDB.

These are the correctness oracle: written in plain SQL over the same parquet
tables (registered as views named like the tables), never generated from the
Spark plans. Shared CTEs: ``raw`` (star tables shaped as raw complaints) and
``silver`` (the conformed rows).

DuckDB notes: sum of ints is HUGEINT (cast to bigint), ``year()`` is BIGINT
(cast to int), decimals are avoided (``100e0``), HALF_UP rounding of a double
is ``round(x::decimal(38,10), s)::double`` as in Spark.
"""

from __future__ import annotations

RAW = """raw AS (
  SELECT
    CASE WHEN s.s_nationkey = 0 THEN 'NA' ELSE CAST(s.s_nationkey AS VARCHAR) || CASE WHEN l.l_linenumber = 4 THEN '.0' ELSE '' END END AS TIPO_ENTIDAD,
    CASE WHEN l.l_suppkey % 20 = 19 THEN 'NA' ELSE CAST(l.l_suppkey AS VARCHAR) END AS CODIGO_ENTIDAD,
    s.s_name || CASE l.l_suppkey % 3 WHEN 0 THEN ' S.A.' WHEN 1 THEN ' Ltda.' ELSE '' END AS NOMBRE_ENTIDAD,
    CASE WHEN p.p_size = 1 THEN ' na ' WHEN p.p_size = 2 THEN NULL ELSE ' ' || p.p_brand || ' ' END AS PRODUCTO,
    CASE WHEN l.l_linenumber = 1 AND l.l_returnflag = 'N' THEN 'NA'
         ELSE l.l_returnflag || '-' || o.o_orderpriority END AS MOTIVO,
    CASE o.o_orderstatus WHEN 'O' THEN 'Vigentes' WHEN 'F' THEN ' Recibidos ' ELSE 'Cerrados' END AS ESTADO,
    CASE WHEN l.l_orderkey % 211 = 0 THEN '16' ELSE
      substr(CAST(year(l.l_shipdate) AS VARCHAR), 1, 1) || '.' || substr(CAST(year(l.l_shipdate) AS VARCHAR), 2) END AS ANIO,
    CAST(month(l.l_shipdate) AS VARCHAR) || CASE WHEN l.l_linenumber = 3 THEN '.0' ELSE '' END AS MES
  FROM (SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE 1 + ((l_suppkey - 1) * (l_orderkey % 97)) // 97 END
                          AS l_suppkey) FROM lineitem) l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

# a code: whole digits, zero decimals allowed, within an int
_CODE = r"TRY_CAST(nullif(regexp_extract(trim({c}), '^([+-]?[0-9]+)([.]0*)?$', 1), '') AS INTEGER)"

PARSED = rf"""parsed AS (
  SELECT *, CASE WHEN y BETWEEN 1900 AND 2100 THEN y END AS anio_n,
    {_CODE.format(c='MES')} AS mes_n,
    {_CODE.format(c='TIPO_ENTIDAD')} AS tip_n,
    {_CODE.format(c='CODIGO_ENTIDAD')} AS cod_n
  FROM (SELECT *,
      CASE WHEN regexp_matches(t, '^[0-9][.][0-9]{{1,3}}$') THEN CAST(rpad(replace(t, '.', ''), 4, '0') AS INTEGER)
           WHEN regexp_matches(t, '^[0-9]{{4}}([.]0*)?$') THEN CAST(substr(t, 1, 4) AS INTEGER) END AS y
    FROM (SELECT *, replace(trim(ANIO), ',', '.') AS t FROM raw) a) b
)"""

SILVER = r"""silver AS (
  SELECT tip_n AS tipo_entidad_id, cod_n AS codigo_entidad,
    trim(regexp_replace(regexp_replace(upper(NOMBRE_ENTIDAD), '\s+S\.A\.?\s*$', ''), '\s+LTDA\.?\s*$', '')) AS nombre_entidad,
    CASE WHEN upper(trim(PRODUCTO)) = 'NA' OR PRODUCTO IS NULL THEN 'NO ESPECIFICADO' ELSE trim(PRODUCTO) END AS producto,
    CASE WHEN upper(trim(MOTIVO)) = 'NA' OR MOTIVO IS NULL THEN 'NO ESPECIFICADO' ELSE trim(MOTIVO) END AS motivo,
    trim(upper(ESTADO)) AS estado, anio_n AS anio, mes_n AS mes,
    make_date(anio_n, mes_n, 1) AS fecha_queja,
    CAST(anio_n AS VARCHAR) || '-' || lpad(CAST(mes_n AS VARCHAR), 2, '0') AS periodo_mes,
    'Q' || CAST(quarter(make_date(anio_n, mes_n, 1)) AS VARCHAR) AS trimestre,
    CASE WHEN tip_n = 1 THEN 'BANCO' WHEN tip_n IN (23, 24, 25) THEN 'PENSION Y CESANTIAS'
         WHEN tip_n IN (2, 3) THEN 'CORPORACION FINANCIERA' WHEN tip_n IN (5, 6) THEN 'SEGUROS'
         WHEN tip_n IN (7, 8) THEN 'SOCIEDADES FIDUCIARIAS' ELSE 'OTRA ENTIDAD FINANCIERA' END AS tipo_entidad_desc
  FROM parsed
  WHERE anio_n IS NOT NULL AND mes_n BETWEEN 1 AND 12 AND tip_n IS NOT NULL AND cod_n IS NOT NULL
)"""

ENTITY = """entity AS (
  SELECT codigo_entidad, nombre_entidad, tipo_entidad_desc,
    count(*) AS total_quejas,
    count(DISTINCT producto) AS productos_distintos,
    count(DISTINCT motivo) AS motivos_distintos,
    min(fecha_queja) AS primera_queja,
    max(fecha_queja) AS ultima_queja,
    count(DISTINCT periodo_mes) AS meses_con_quejas,
    CAST(sum(CASE WHEN estado = 'VIGENTES' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_vigentes,
    CAST(sum(CASE WHEN estado = 'RECIBIDOS' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_recibidas,
    round(CAST(count(*) / count(DISTINCT periodo_mes) AS DECIMAL(38, 10)), 2)::DOUBLE AS promedio_quejas_por_mes
  FROM silver GROUP BY codigo_entidad, nombre_entidad, tipo_entidad_desc
)"""

MONTHLY = """monthly AS (
  SELECT *,
    round(CAST(avg(total_quejas) OVER (ORDER BY fecha_queja ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DECIMAL(38, 10)), 2)::DOUBLE AS promedio_movil_3meses,
    CASE WHEN total_quejas > lag(total_quejas) OVER (ORDER BY fecha_queja) THEN 'AUMENTO'
         WHEN total_quejas < lag(total_quejas) OVER (ORDER BY fecha_queja) THEN 'DISMINUCION'
         ELSE 'ESTABLE' END AS tendencia
  FROM (
    SELECT anio, mes, periodo_mes, fecha_queja,
      count(*) AS total_quejas,
      count(DISTINCT nombre_entidad) AS entidades_con_quejas,
      count(DISTINCT producto) AS productos_distintos,
      CAST(sum(CASE WHEN tipo_entidad_desc = 'BANCO' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_bancos,
      CAST(sum(CASE WHEN tipo_entidad_desc = 'PENSION Y CESANTIAS' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_pensiones,
      CAST(sum(CASE WHEN tipo_entidad_desc = 'SEGUROS' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_seguros,
      CAST(sum(CASE WHEN estado = 'VIGENTES' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_vigentes,
      CAST(sum(CASE WHEN estado = 'RECIBIDOS' THEN 1 ELSE 0 END) AS BIGINT) AS quejas_recibidas
    FROM silver GROUP BY anio, mes, periodo_mes, fecha_queja
  ) m
)"""


def r2(expr: str, scale: int = 2) -> str:
    """HALF_UP rounding of a double, as Spark's round."""
    return f"round(CAST(({expr}) AS DECIMAL(38, 10)), {scale})::DOUBLE"


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def on_silver(body: str, *extra: str) -> str:
    return with_ctes(body, RAW, PARSED, SILVER, *extra)


def on_raw(body: str, *extra: str) -> str:
    return with_ctes(body, RAW, *extra)
