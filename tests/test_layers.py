"""The user path: raw complaint CSV -> every layer written and read back."""

import os
import tempfile

from medalla.plans.medallion import build_layers
from medalla.schema import RAW_SCHEMA
from medalla.sources.layers import layer_row_counts, read_layer, read_raw_csv

from test_conform import GOLDEN_RAW


def test_csv_to_layers(spark):
    root = tempfile.mkdtemp(prefix="layers-test-", dir="/tmp")
    csv = os.path.join(root, "raw_csv")
    (spark.createDataFrame(GOLDEN_RAW, RAW_SCHEMA).coalesce(1).write.option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(csv))
    raw = read_raw_csv(spark, csv)
    assert raw.count() == 12
    paths = build_layers(spark, raw, os.path.join(root, "out"), with_segments=False)
    counts = {r.tabla: r.registros for r in layer_row_counts(
        {n: read_layer(spark, path=p) for n, p in paths.items()}).collect()}
    assert counts["quejas_financieras_raw"] == 12
    assert counts["quejas_limpias"] == 6
    assert counts["quejas_rechazadas"] == 6
    assert counts["dashboard_kpis"] == 6
    silver = read_layer(spark, path=paths["quejas_limpias"])
    # padding inside values survives the CSV round trip and is trimmed by conform
    assert {r.producto for r in silver.collect()} >= {"Tarjetas de crédito", "NO ESPECIFICADO"}
    # the silver layer is laid out by year
    assert any(d.startswith("anio=") for d in os.listdir(paths["quejas_limpias"].replace("file:", "")))


def test_csv_columns_by_name(spark):
    import pytest

    root = tempfile.mkdtemp(prefix="csv-order-", dir="/tmp")
    raw = spark.createDataFrame(GOLDEN_RAW, RAW_SCHEMA)
    shuffled = raw.select("ESTADO", "MOTIVO", "PRODUCTO", "NOMBRE_ENTIDAD", "CODIGO_ENTIDAD",
                          "TIPO_ENTIDAD", "MES", "ANIO").withColumn("EXTRA", raw["ANIO"])
    path = os.path.join(root, "shuffled")
    shuffled.coalesce(1).write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    back = read_raw_csv(spark, path).drop("_rescued_data")
    assert back.columns == list(RAW_SCHEMA.fieldNames())
    assert sorted(map(tuple, back.collect()), key=str) == sorted(GOLDEN_RAW, key=str)
    partial = os.path.join(root, "partial")
    raw.drop("MES").coalesce(1).write.option("header", True).csv(partial)
    with pytest.raises(ValueError, match="MES"):
        read_raw_csv(spark, partial)


def test_schema_mismatch_raises(spark, tmp_path):
    import pytest

    from medalla.schema import SILVER_SCHEMA
    from medalla.sources.layers import write_layer

    df = spark.createDataFrame([], SILVER_SCHEMA)
    write_layer(df, path=str(tmp_path / "ok"), schema=SILVER_SCHEMA)
    for bad in (df.drop("anio"), df.withColumn("anio", df.anio.cast("string")), df.withColumn("x", df.anio)):
        with pytest.raises(ValueError, match="layer schema differs"):
            write_layer(bad, path=str(tmp_path / "bad"), schema=SILVER_SCHEMA)


def test_layers_follow_their_source_files(spark, tmp_path):
    import shutil

    from conftest import SF_SMALL
    from medalla.plans.layers import bronze_layer

    for t in ("lineitem", "orders", "part", "supplier"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    n = bronze_layer(spark, str(tmp_path)).count()
    (tmp_path / "lineitem.parquet").unlink()
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(10).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert bronze_layer(spark, str(tmp_path)).count() == 10 < n


def test_files_bound_the_rows_of_a_task(spark):
    from medalla.sources.layers import ROWS_PER_FILE, write_layer

    path = os.path.join(tempfile.mkdtemp(prefix="layer-files-", dir="/tmp"), "t")
    write_layer(spark.range(2 * ROWS_PER_FILE + 1).coalesce(1).selectExpr("id", "0 as anio"), path=path, partition_by=["anio"])
    table = read_layer(spark, path=path)
    per = [r["count"] for r in table.selectExpr("_metadata.file_path as f").groupBy("f").count().collect()]
    assert len(per) == 3 and max(per) <= ROWS_PER_FILE and table.count() == 2 * ROWS_PER_FILE + 1
