"""Incremental refresh: only files not yet taken in are read, only the years
they touch are recounted.

``manifiesto``   one row per file taken in: path, size, time, load number
``quejas_limpias``  silver by (anio, lote); a load writes its own folders
``cubo_quejas``  the count cube by anio; a load overwrites the years it touches
gold tables      rebuilt from the cube (not from silver)

The manifest is written last: a load that failed before is done again under
the same number and overwrites what it had written. A file whose size or time
has changed is taken in again; its older rows no longer count, because only
the rows of a file's last load are read, and the years they were in are
recounted as well. Files that have gone from the folder stay counted.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalla.operators.conform import conform
from medalla.operators.cube import COUNT, DIMS, count_cube, gold_tables
from medalla.plans.medallion import CUBE
from medalla.schema import RAW_COLUMNS, SILVER_SCHEMA
from medalla.sources.layers import write_layer
from medalla.session import materialize

FILE, LOAD = "archivo", "lote"
_MANIFEST = T.StructType([T.StructField(FILE, T.StringType()), T.StructField("bytes", T.LongType()),
                          T.StructField("modificado", T.TimestampType())])


class IncrementalLayers:
    """The layers below ``root`` (shared folder), fed from the files of
    ``landing``. ``read`` turns a list of files into raw rows that keep
    Spark's hidden ``_metadata`` column (default: Parquet)."""

    def __init__(self, spark: SparkSession, landing: str, root: str, read: Callable[[list[str]], DataFrame] | None = None):
        self.spark, self.landing, self.root = spark, landing, root
        self.read = read or (lambda files: spark.read.parquet(*files))
        self._schemas: dict[str, T.StructType] = {}
        self._empty("manifiesto", _MANIFEST, (LOAD,))
        silver = T.StructType([*SILVER_SCHEMA.fields, T.StructField(FILE, T.StringType())])
        self._empty("quejas_limpias", silver, ("anio", LOAD))
        kinds = {f.name: f.dataType for f in SILVER_SCHEMA.fields}
        self._empty(CUBE, T.StructType([*(T.StructField(d, kinds[d]) for d in DIMS), T.StructField(COUNT, T.LongType())]), ("anio",))

    def _empty(self, name: str, schema: T.StructType, by: tuple[str, ...]) -> None:
        """Notes a table's schema and makes its folder if there is none."""
        fields = [f for f in schema.fields if f.name not in by] + [f for f in schema.fields if f.name in by]
        fields += [T.StructField(b, T.IntegerType()) for b in by if b not in schema.names]
        self._schemas[name] = T.StructType(fields)
        self.spark.createDataFrame([], self._schemas[name]).write.mode("append").partitionBy(*by).parquet(f"{self.root}/{name}")

    def table(self, name: str) -> DataFrame:
        """A partitioned table as it is on disk."""
        return self.spark.read.schema(self._schemas[name]).parquet(f"{self.root}/{name}")

    def _overwrite(self, df: DataFrame, name: str, by: tuple[str, ...]) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
         .parquet(f"{self.root}/{name}"))

    def _last(self, manifest: DataFrame) -> DataFrame:
        """The load that counts of each file."""
        return manifest.groupBy(FILE).agg(F.max(LOAD).alias(LOAD))

    def silver(self, manifest: DataFrame | None = None) -> DataFrame:
        """Silver without rows that a later load of their file has replaced."""
        last = self._last(self.table("manifiesto") if manifest is None else manifest)
        return self.table("quejas_limpias").join(last, [FILE, LOAD], "left_semi")

    def cube(self) -> DataFrame:
        return self.table(CUBE)

    def pending(self) -> DataFrame:
        """Files of the landing folder that are new or have changed."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.landing)
                 .where(F.col("length") > 0)
                 .select(F.col("_metadata.file_path").alias(FILE), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modificado")))
        return files.join(self.table("manifiesto"), [FILE, "bytes", "modificado"], "left_anti")

    def refresh(self, gold: bool = True) -> dict[str, Any]:
        """One load. Returns its number, its files and the years recounted;
        without new files nothing is written."""
        manifest = self.table("manifiesto")
        # what is new is fixed once: files may land while the load runs
        new = materialize(self.pending(), "pending-files")
        files = sorted(r["path"] for r in new.select("path").collect())  # names of one load's files
        new = new.drop("path")
        if not files:
            return {LOAD: None, "archivos": 0, "anios": []}
        load = (manifest.agg(F.max(LOAD)).first()[0] or 0) + 1
        raw = self.read(files)
        rows = raw.select(*[c for c in raw.columns if c in (*RAW_COLUMNS, "_rescued_data")], F.col("_metadata.file_path").alias(FILE))
        rows = conform(rows, keep=[FILE]).withColumn(LOAD, F.lit(load))
        self._overwrite(rows, "quejas_limpias", ("anio", LOAD))
        taken = manifest.unionByName(new.withColumn(LOAD, F.lit(load)))
        every = self.table("quejas_limpias")
        years = {r[0] for r in every.where(F.col(LOAD) == load).select("anio").distinct().collect()}  # from folder names
        again = manifest.select(FILE).join(new, FILE, "left_semi").distinct()
        if not again.isEmpty():  # files taken in anew: the rows are read for the years that they were in
            years |= {r[0] for r in every.join(again, FILE, "left_semi").select("anio").distinct().collect()}
        years = sorted(years)
        touched = self.silver(taken).where(F.col("anio").isin(years))  # prunes the folders of other years
        counted = materialize(count_cube(touched), "touched-years")
        self._overwrite(counted, CUBE, ("anio",))
        for year in set(years) - {r[0] for r in counted.select("anio").distinct().collect()}:
            # all its rows have been replaced: an overwrite by partitions would leave the old folder
            counted.drop("anio").limit(0).write.mode("overwrite").parquet(f"{self.root}/{CUBE}/anio={year}")
        if gold:
            # independent jobs, submitted together so that small ones share the cores
            with ThreadPoolExecutor(max_workers=4) as pool:
                done = [pool.submit(lambda n=name, b=build: write_layer(b(), path=f"{self.root}/{n}"))
                        for name, build in gold_tables(self.cube()).items()]
                for f in done:
                    f.result()
        self._overwrite(new.withColumn(LOAD, F.lit(load)), "manifiesto", (LOAD,))
        return {LOAD: load, "archivos": len(files), "anios": years}
