"""Bronze -> silver: validate, conform, and keep the rejected rows.

A line that the CSV reader could not parse (its text is in ``_rescued_data``)
is rejected first: its fields may have shifted into the wrong columns.
A filter on conformed columns is not pushed into the bronze scan.

One narrow pass (no shuffle): the raw codes are parsed once under
temporary names, the validity rule is applied, and the 12 silver columns are
derived in a single select. Spark resolves names case-insensitively, so the
parsed values must not be called like the raw columns they come from.

Validity is applied as ``explode(when(valid, array(row)))`` rather than as a
``filter``: Catalyst would inline the parsed expressions into a Filter once
per reference and push it to the scan, re-parsing every year and code
several times per row (5x slower at sf0.1). Behind the generator each value
is parsed once, in a projection with common-subexpression elimination, and a
row whose array is NULL simply produces no output row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medalla.functions.scalar import (
    categorize,
    fill_unspecified,
    month_key,
    month_start,
    normalize_month,
    normalize_year,
    parse_code,
    quarter_label,
    standardize_name,
)
from medalla.schema import RAW_RESCUE, SILVER_STAMP

_Y, _M, _T, _C, _L = "anio_n", "mes_n", "tip_n", "cod_n", "linea_n"

# reject reasons, in the order the rules are checked
REJECT_LINE = "LINEA_CORRUPTA"
REJECT_YEAR = "ANIO_INVALIDO"
REJECT_MONTH = "MES_INVALIDO"
REJECT_TYPE = "TIPO_ENTIDAD_INVALIDO"
REJECT_CODE = "CODIGO_ENTIDAD_INVALIDO"


def _parsed(raw: DataFrame, year="ANIO", month="MES", etype="TIPO_ENTIDAD",
            code="CODIGO_ENTIDAD") -> DataFrame:
    corrupt = F.col(RAW_RESCUE).isNotNull() if RAW_RESCUE in raw.columns else F.lit(False)
    return raw.select(
        "*",
        corrupt.alias(_L),
        normalize_year(year).alias(_Y),
        normalize_month(month).alias(_M),
        parse_code(etype).alias(_T),
        parse_code(code).alias(_C),
    )


def _valid() -> Column:
    return (~F.col(_L) & F.col(_Y).isNotNull() & F.col(_M).between(1, 12)
            & F.col(_T).isNotNull() & F.col(_C).isNotNull())


def _reason() -> Column:
    return (F.when(F.col(_L), F.lit(REJECT_LINE))
             .when(F.col(_Y).isNull(), F.lit(REJECT_YEAR))
             .when(F.col(_M).isNull() | ~F.col(_M).between(1, 12), F.lit(REJECT_MONTH))
             .when(F.col(_T).isNull(), F.lit(REJECT_TYPE))
             .when(F.col(_C).isNull(), F.lit(REJECT_CODE)))


def _keep_where(df: DataFrame, cond: Column, cols: list[Column]) -> DataFrame:
    """``df.filter(cond).select(cols)`` evaluated in one projection."""
    row = F.struct(*cols)
    return df.select(F.explode(F.when(cond, F.array(row))).alias("_r")).select("_r.*")


def conform(raw: DataFrame, stamp: bool = False, year="ANIO", month="MES",
            etype="TIPO_ENTIDAD", code="CODIGO_ENTIDAD", name="NOMBRE_ENTIDAD",
            product="PRODUCTO", reason="MOTIVO", state="ESTADO", keep=()) -> DataFrame:
    """Accepted rows in the silver shape (12 columns, plus the processing
    timestamp when ``stamp`` and the columns ``keep`` of the raw rows)."""
    p = _parsed(raw, year, month, etype, code)
    date = month_start(_Y, _M)
    cols = [
        F.col(_T).alias("tipo_entidad_id"),
        F.col(_C).alias("codigo_entidad"),
        standardize_name(name).alias("nombre_entidad"),
        fill_unspecified(product).alias("producto"),
        fill_unspecified(reason).alias("motivo"),
        F.trim(F.upper(F.col(state))).alias("estado"),
        F.col(_Y).alias("anio"),
        F.col(_M).alias("mes"),
        date.alias("fecha_queja"),
        month_key(_Y, _M).alias("periodo_mes"),
        quarter_label(date).alias("trimestre"),
        categorize(_T).alias("tipo_entidad_desc"),
        *map(F.col, keep),
    ]
    out = _keep_where(p, F.coalesce(_valid(), F.lit(False)), cols)
    if stamp:
        out = out.withColumn(SILVER_STAMP, F.current_timestamp())
    return out


def rejects(raw: DataFrame, year="ANIO", month="MES", etype="TIPO_ENTIDAD",
            code="CODIGO_ENTIDAD") -> DataFrame:
    """The raw rows ``conform`` drops, unchanged, with ``motivo_rechazo``
    naming the first rule they break."""
    p = _parsed(raw, year, month, etype, code)
    cols = [F.col(c) for c in raw.columns] + [_reason().alias("motivo_rechazo")]
    return _keep_where(p, ~F.coalesce(_valid(), F.lit(False)), cols)
