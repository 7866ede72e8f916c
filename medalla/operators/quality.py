"""Data-quality profiles of the raw and clean layers.

Each profile is ONE aggregate over the table (the per-column loops of a
notebook become columns of a single ``agg``), unpivoted into rows with
``stack`` when the result is one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalla.functions.scalar import is_marker, normalize_year, pct
from medalla.schema import NA_MARKERS, RAW_RESCUE, UNSPECIFIED


def _distinct(c: str, approx: bool):
    return F.approx_count_distinct(c) if approx else F.countDistinct(c)


def dataset_profile(raw: DataFrame, year: str = "ANIO", entity: str = "NOMBRE_ENTIDAD",
                    product: str = "PRODUCTO", reason: str = "MOTIVO", state: str = "ESTADO",
                    etype: str = "TIPO_ENTIDAD", approx: bool = False) -> DataFrame:
    """Rows, distinct counts of the raw text columns, first/last year.

    Six exact distinct counts make Catalyst expand each row seven times
    before the partial aggregate; ``approx=True`` uses HyperLogLog sketches
    instead (one pass, fixed memory) for very large tables."""
    y = normalize_year(year)
    return raw.agg(
        F.count(F.lit(1)).alias("total_registros"),
        _distinct(year, approx).alias("total_anios"),
        F.min(y).alias("anio_inicial"),
        F.max(y).alias("anio_final"),
        _distinct(entity, approx).alias("total_entidades"),
        _distinct(product, approx).alias("total_productos"),
        _distinct(reason, approx).alias("total_motivos"),
        _distinct(state, approx).alias("total_estados"),
        _distinct(etype, approx).alias("total_tipos_entidad"),
    )


def _unpivot(one_row: DataFrame, names: Sequence[str], fields: Sequence[str], label: str) -> DataFrame:
    """One row with columns f_<name> -> one row per name."""
    rows = F.array(*[
        F.struct(F.lit(n).alias(label), *[F.col(f"{f}_{i}").alias(f) for f in fields])
        for i, n in enumerate(names)])
    return one_row.select(F.inline(rows))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(columna, valores_nulos, porcentaje_nulos) for every column, most nulls
    first, from one aggregate."""
    cols = [c for c in (columns or df.columns) if c != RAW_RESCUE]
    n = F.count(F.lit(1))
    aggs = [n.alias("_n")]
    for i, c in enumerate(cols):
        aggs.append((n - F.count(F.col(f"`{c}`"))).alias(f"valores_nulos_{i}"))
    one = df.agg(*aggs)
    one = one.select("*", *[pct(F.col(f"valores_nulos_{i}"), F.col("_n")).alias(f"porcentaje_nulos_{i}")
                            for i in range(len(cols))])
    out = _unpivot(one, cols, ["valores_nulos", "porcentaje_nulos"], "columna")
    return out.orderBy(F.col("valores_nulos").desc(), "columna")


def marker_profile(df: DataFrame, columns: Sequence[str] = ("PRODUCTO", "MOTIVO"),
                   markers: Sequence[str] = NA_MARKERS) -> DataFrame:
    """(columna, cantidad, porcentaje) of values equal to a missing-value
    marker after upper(trim())."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        aggs.append(F.count_if(is_marker(c, markers)).alias(f"cantidad_{i}"))
    one = df.agg(*aggs)
    one = one.select("*", *[pct(F.col(f"cantidad_{i}"), F.col("_n")).alias(f"porcentaje_{i}")
                            for i in range(len(columns))])
    return _unpivot(one, list(columns), ["cantidad", "porcentaje"], "columna")


def default_value_profile(silver: DataFrame, columns: Sequence[str] = ("producto", "motivo"),
                          default: str = UNSPECIFIED) -> DataFrame:
    """(columna, cantidad, porcentaje) of the default value in the clean layer."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        aggs.append(F.count_if(F.col(c) == default).alias(f"cantidad_{i}"))
    one = silver.agg(*aggs)
    one = one.select("*", *[pct(F.col(f"cantidad_{i}"), F.col("_n")).alias(f"porcentaje_{i}")
                            for i in range(len(columns))])
    return _unpivot(one, list(columns), ["cantidad", "porcentaje"], "columna")


def schema_profile(df: DataFrame) -> DataFrame:
    """(posicion, columna, tipo, nullable, valores_no_nulos) - one row per
    column: the declared schema next to the observed non-NULL count, from
    one aggregate over the table."""
    fields = df.schema.fields
    one = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(i + 1).alias("posicion"), F.lit(f.name).alias("columna"),
                 F.lit(f.dataType.simpleString()).alias("tipo"), F.lit(f.nullable).alias("nullable"),
                 F.col(f"n{i}").alias("valores_no_nulos"))
        for i, f in enumerate(fields)])))


def sample_rows(df: DataFrame, n: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """Deterministic sample: the first n rows in the order of all columns
    (a per-partition top-n, then one merge)."""
    cols = list(columns or df.columns)
    return df.select(*cols).orderBy(*[F.col(c).asc_nulls_first() for c in cols]).limit(n)


def silver_verification(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.countDistinct("anio").alias("total_anios"),
        F.min("fecha_queja").alias("fecha_minima"),
        F.max("fecha_queja").alias("fecha_maxima"),
        F.countDistinct("nombre_entidad").alias("total_entidades"),
        F.countDistinct("producto").alias("total_productos"),
    )


def date_validation(silver: DataFrame) -> DataFrame:
    """Per year: rows, first/last date, months with data, and flags that the
    dates are inside the year and the year inside the expected range."""
    return silver.groupBy("anio").agg(
        F.count(F.lit(1)).alias("registros"),
        F.min("fecha_queja").alias("primera_fecha"),
        F.max("fecha_queja").alias("ultima_fecha"),
        F.countDistinct("periodo_mes").alias("meses_con_datos"),
    ).withColumn(
        "fechas_validas",
        (F.year("primera_fecha") == F.col("anio")) & (F.year("ultima_fecha") == F.col("anio"))
        & (F.col("meses_con_datos") <= 12) & F.col("anio").between(1900, 2100)).orderBy("anio")


def completeness(silver: DataFrame, columns: Sequence[str] = ("nombre_entidad", "producto", "motivo", "estado"),
                 date_col: str = "fecha_queja") -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("total_registros")]
    aggs += [F.count(c).alias(f"{c}_completo") for c in columns]
    aggs.append(F.count(date_col).alias(f"{date_col}_completa"))
    return silver.agg(*aggs).withColumn(
        "porcentaje_completitud", pct(F.col(f"{date_col}_completa"), F.col("total_registros")))
