"""Written layers shared by the queries of one session.

As in a medallion warehouse, bronze profiles read the BRONZE table, silver is
conformed from bronze, gold and analytics queries read the SILVER table and
ML queries read the GOLD entity table, cluster reports read the one
K-Means segmentation - each written once by Spark (from the
source tables, or the layer below) into the session's shared checkpoint
folder - instead of re-deriving them from the source tables in every query.
A layer is rebuilt per Spark application and state of the source files; the write is a
full overwrite, so a retried build after a failure yields the same table.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from medalla.operators import marts
from medalla.operators.conform import conform
from medalla.plans.medallion import scratch_root
from medalla.schema import SILVER_SCHEMA
from medalla.sources.layers import read_layer, write_layer
from medalla.sources.star import raw_from_star

_BUILT: dict[tuple, tuple[str, object]] = {}
_LOCK = threading.RLock()

#: source tables that the layers are made of
_SOURCES = ("lineitem", "orders", "part", "supplier")


def _version(spark: SparkSession, sf: str) -> tuple:
    """Sizes and times of the source files: a layer is rebuilt when they
    change. Asks the file system that Spark reads from."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for name in _SOURCES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf.rstrip('/')}/{name}.parquet")
        files = path.getFileSystem(conf).listStatus(path)
        out.append(tuple((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files))
    return tuple(out)


def _build_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return raw_from_star(spark, sf)


def _build_silver(spark: SparkSession, sf: str) -> DataFrame:
    return conform(bronze_layer(spark, sf))


def _build_entity(spark: SparkSession, sf: str) -> DataFrame:
    return marts.entity_metrics(silver_layer(spark, sf))


def _build_cube(spark: SparkSession, sf: str) -> DataFrame:
    from medalla.operators.cube import count_cube

    return count_cube(silver_layer(spark, sf))


def _build_segments(spark: SparkSession, sf: str) -> DataFrame:
    from medalla.operators.segment import segment_entities

    return segment_entities(entity_layer(spark, sf))


_BUILDERS = {
    "quejas_financieras_raw": (_build_bronze, ()),
    "quejas_limpias": (_build_silver, ("anio",)),
    "metricas_por_entidad": (_build_entity, ()),
    "cubo_quejas": (_build_cube, ("anio",)),
    "segmentos_entidades": (_build_segments, ()),
}


def layer_path(spark: SparkSession, sf: str, name: str) -> str:
    """Folder of the written layer ``name`` (built on first use)."""
    layer(spark, sf, name)
    return _BUILT[_key(spark, sf, name)][0]


def _key(spark: SparkSession, sf: str, name: str) -> tuple:
    return spark.sparkContext.applicationId, sf.rstrip("/"), name, _version(spark, sf)


def layer(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The written layer ``name`` for source folder ``sf`` (built on first use)."""
    key = _key(spark, sf, name)
    with _LOCK:
        hit = _BUILT.get(key)
        if hit is None:
            build, partition_by = _BUILDERS[name]
            path = scratch_root(spark, name)
            write_layer(build(spark, sf), path=path, partition_by=partition_by,
                        schema=SILVER_SCHEMA if name == "quejas_limpias" else None)
            df = read_layer(spark, path=path)
            _BUILT[key] = (path, df.schema)  # later reads skip schema inference
            return df
    path, schema = hit
    return spark.read.schema(schema).parquet(path)


def bronze_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Raw complaint rows as loaded (all text)."""
    return layer(spark, sf, "quejas_financieras_raw")


def silver_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Silver, partitioned by year on disk (a year filter prunes folders)."""
    return layer(spark, sf, "quejas_limpias")


def entity_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Gold entity mart (with its rank)."""
    return layer(spark, sf, "metricas_por_entidad")


def cube_layer(spark: SparkSession, sf: str) -> DataFrame:
    """The count cube of silver, by year."""
    return layer(spark, sf, "cubo_quejas")


def segments_layer(spark: SparkSession, sf: str) -> DataFrame:
    """Entities with their K-Means cluster, label and scaled feature vector
    (one fit per session; the cluster reports read it)."""
    return layer(spark, sf, "segmentos_entidades")
