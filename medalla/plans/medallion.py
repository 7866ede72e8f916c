"""Layered build: bronze -> silver (+ rejects) -> gold marts -> analytics.

Every layer is written as a table and the next layer reads the WRITTEN
table back, never the in-memory plan: a layer can be rebuilt on its own,
the lineage of each job stops at the previous layer, and a lost executor
costs at most the current layer's tasks.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from medalla.operators.conform import conform, rejects
from medalla.operators.cube import count_cube, gold_tables
from medalla.schema import SILVER_SCHEMA, SILVER_STAMP
from medalla.session import scratch_root  # noqa: F401  (re-exported)
from medalla.sources.layers import read_layer, write_layer
from medalla.sources.star import raw_from_star

GOLD_TABLES = ("metricas_por_entidad", "metricas_por_producto", "metricas_temporales",
               "ranking_entidades", "dashboard_kpis")
#: the written count cube beside the layers (not a table of the load report)
CUBE = "cubo_quejas"


def build_layers(spark: SparkSession, raw: DataFrame, root: str, fmt: str = "parquet",
                 stamp: bool = True, with_segments: bool = False,
                 partition_silver_by: tuple[str, ...] = ("anio",), parallel_jobs: int = 4) -> dict[str, str]:
    """Write every layer under ``root`` starting from the bronze rows ``raw``
    (a raw complaint CSV read with ``read_raw_csv``, or ``raw_from_star``);
    return {table: path}."""
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame, partition_by=(), schema=None) -> DataFrame:
        p = f"{root}/{name}"
        write_layer(df, path=p, fmt=fmt, partition_by=partition_by, schema=schema)
        paths[name] = p
        return read_layer(spark, path=p, fmt=fmt)

    bronze = put("quejas_financieras_raw", raw)
    declared = T.StructType([*SILVER_SCHEMA.fields, *([T.StructField(SILVER_STAMP, T.TimestampType())] if stamp else [])])
    silver = put("quejas_limpias", conform(bronze, stamp=stamp), partition_silver_by, declared)
    # silver is read once, into the count cube; the five gold tables read that
    write_layer(count_cube(silver), path=f"{root}/{CUBE}", fmt=fmt)
    cube = read_layer(spark, path=f"{root}/{CUBE}", fmt=fmt)
    # the rejects and the five gold tables are independent jobs, submitted
    # together so small ones share the cores
    gold = {"quejas_rechazadas": lambda: rejects(bronze), **gold_tables(cube, stamp)}
    with ThreadPoolExecutor(max_workers=max(1, parallel_jobs)) as pool:
        done = {name: pool.submit(lambda n=name, b=build: put(n, b())) for name, build in gold.items()}
        written = {name: f.result() for name, f in done.items()}
    if with_segments:
        from medalla.operators import segment

        entity = written["metricas_por_entidad"]
        put("clustering_entidades", segment.clustering_table(segment.segment_entities(entity), stamp=stamp))
    return paths


def main(argv: list[str] | None = None) -> None:
    """python -m medalla.plans.medallion (--csv PATH | --star DIR) --out ROOT"""
    import argparse

    from medalla.session import get_spark
    from medalla.sources.layers import layer_row_counts, read_raw_csv

    ap = argparse.ArgumentParser(description="build bronze, silver and gold layers")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="raw complaint CSV file or folder (header row)")
    src.add_argument("--star", help="folder with the star-schema parquet tables")
    ap.add_argument("--out", required=True, help="root folder of the layer tables")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--sep", default=",")
    ap.add_argument("--encoding", default="UTF-8", help="e.g. ISO-8859-1 for Latin-1 exports")
    ap.add_argument("--segments", action="store_true", help="also fit and write the K-Means table")
    a = ap.parse_args(argv)
    spark = get_spark()
    raw = read_raw_csv(spark, a.csv, sep=a.sep, encoding=a.encoding) if a.csv else raw_from_star(spark, a.star)
    paths = build_layers(spark, raw, a.out, fmt=a.format, with_segments=a.segments)
    layer_row_counts({n: read_layer(spark, path=p, fmt=a.format) for n, p in paths.items()}).show(truncate=False)


if __name__ == "__main__":
    main()
