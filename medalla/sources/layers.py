"""Layer IO: raw CSV ingest, layer tables written and read back, load report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalla.schema import RAW_COLUMNS, RAW_RESCUE

#: rows of a layer file. Spark deals files to tasks by their bytes, and
#: repeated values shrink to a few bytes a row, so the rows of one task would
#: grow with the table. Every file counts as spark.sql.files.openCostInBytes
#: besides, so files of so many rows bound the rows, and the memory, of a task
ROWS_PER_FILE = 50_000


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str] = RAW_COLUMNS,
                 sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Raw complaint CSV with a header, every column read as text.

    Columns are taken by NAME from the header (any order, any extra columns;
    a missing required column is an error), so no value can shift into the
    wrong column. Padding inside values is kept for the conform step to
    trim. Malformed lines are kept: their text lands in ``_rescued_data``
    and the conform step rejects them with a reason.
    """
    def reader():
        return (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
                .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))

    header = reader().csv(path).columns  # the header line only
    present = {h.lower() for h in header}
    missing = [c for c in columns if c.lower() not in present]
    if missing:
        raise ValueError(f"raw CSV at {path} lacks columns {missing}")
    full = T.StructType([T.StructField(h, T.StringType(), True) for h in header]
                        + [T.StructField(RAW_RESCUE, T.StringType(), True)])
    df = (reader().schema(full)
          .option("enforceSchema", False)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", RAW_RESCUE)
          .csv(path))
    return df.select(*columns, RAW_RESCUE)


def write_layer(df: DataFrame, table: str | None = None, path: str | None = None,
                fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite", schema: T.StructType | None = None) -> None:
    """Full overwrite of one layer table (schema replaced with the new one).
    With ``schema`` the columns and types must be the declared ones.

    Give ``table`` to save into the session catalog, or ``path`` to write
    files. ``partition_by`` lays the files out by those columns so that a
    filter on them prunes whole folders. Files hold ``ROWS_PER_FILE`` rows
    at most.
    """
    if schema is not None:
        check_schema(df, schema)
    w = df.write.format(fmt).mode(mode).option("overwriteSchema", "true")
    w = w.option("maxRecordsPerFile", ROWS_PER_FILE)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is not None:
        w.save(path)
    elif table is not None:
        w.saveAsTable(table)
    else:
        raise ValueError("give a table name or a path")


def check_schema(df: DataFrame, schema: T.StructType) -> None:
    """Raises ValueError unless ``df`` has just the columns and types of
    ``schema``, in any order."""
    have, want = ({f.name: f.dataType.simpleString() for f in s.fields} for s in (df.schema, schema))
    if have != want:
        wrong = {c: (have.get(c), want.get(c)) for c in have.keys() | want.keys() if have.get(c) != want.get(c)}
        raise ValueError(f"layer schema differs (found, declared): {wrong}")


def read_layer(spark: SparkSession, table: str | None = None, path: str | None = None,
               fmt: str = "parquet") -> DataFrame:
    if path is not None:
        return spark.read.format(fmt).load(path)
    if table is not None:
        return spark.table(table)
    raise ValueError("give a table name or a path")


def layer_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (tabla, registros). A single job: the per-table
    counts are partial aggregates combined in one union."""
    parts = [df.agg(F.count(F.lit(1)).alias("registros"))
               .select(F.lit(name).alias("tabla"), "registros")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
