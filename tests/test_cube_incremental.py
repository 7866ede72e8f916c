"""Count cube and incremental loads."""

import os
import threading
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from medalla.operators import cube as K
from medalla.operators import marts
from medalla.operators.conform import conform
from medalla.plans import incremental
from medalla.plans.incremental import IncrementalLayers
from medalla.schema import RAW_COLUMNS
from medalla.session import scratch_root
from medalla.sources.star import raw_from_star


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _raw(spark, rows):
    base = {"MES": "3", "TIPO_ENTIDAD": "1", "CODIGO_ENTIDAD": "7", "NOMBRE_ENTIDAD": "A", "PRODUCTO": "P", "MOTIVO": "M", "ESTADO": "Vigentes"}
    return spark.createDataFrame([tuple({**base, **r}[c] for c in RAW_COLUMNS) for r in rows], ", ".join(f"{c} string" for c in RAW_COLUMNS))


def test_gold_from_the_cube_equals_gold_from_silver(spark):
    silver = conform(raw_from_star(spark, SF_SMALL)).persist()
    cube = K.count_cube(silver)
    gold = K.gold_tables(cube)
    assert _rows(gold["metricas_por_entidad"]()) == _rows(marts.entity_metrics(silver))
    assert _rows(gold["dashboard_kpis"]()) == _rows(marts.kpi_table(silver))
    assert cube.agg(F.sum("quejas")).first()[0] == silver.count()
    coarse = K.roll_up(cube, ["anio"])
    assert _rows(coarse) == _rows(silver.groupBy("anio").agg(F.count("*")))
    silver.unpersist()


def test_empty_cube(spark):
    silver = conform(_raw(spark, []))
    gold = K.gold_tables(K.count_cube(silver))
    assert gold["metricas_por_entidad"]().count() == 0
    assert _rows(gold["dashboard_kpis"]()) == _rows(marts.kpi_table(silver))


def test_sketches_merge(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 10_000).alias("v"), F.lit(1).alias("quejas"))
    r = K.merge_sketches(K.distinct_sketches(df, ["g"], ["v"]), [], ["v"]).first()
    assert r.quejas == 30_000 and abs(r.v_aprox - 10_000) < 700


def _files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _years(root):
    """Data files of the cube by year."""
    out = {}
    for f in _files(f"{root}/layers/cubo_quejas"):
        out.setdefault(f.split("anio=")[1].split("/")[0], set()).add(f)
    return out


def test_new_and_changed_files(spark):
    root = scratch_root(spark, "incremental-test").removeprefix("file:")
    layers = IncrementalLayers(spark, f"{root}/landing", f"{root}/layers")

    def land(name, rows):
        _raw(spark, rows).coalesce(1).write.mode("overwrite").parquet(f"{root}/landing/{name}")

    def full(*rows):
        return _rows(marts.entity_metrics(conform(_raw(spark, [r for rs in rows for r in rs]))))

    def gold():
        return _rows(spark.read.parquet(f"{root}/layers/metricas_por_entidad").select(*marts.entity_metrics(conform(_raw(spark, []))).columns))

    a = [{"ANIO": "2015"}, {"ANIO": "2016", "NOMBRE_ENTIDAD": "B"}, {"ANIO": "x"}]
    b = [{"ANIO": "2016"}, {"ANIO": "2016", "PRODUCTO": None}]
    land("a", a)
    assert layers.refresh() == {"lote": 1, "archivos": 1, "anios": [2015, 2016]}
    assert layers.refresh() == {"lote": None, "archivos": 0, "anios": []}
    before = _years(root)
    land("b", b)
    assert layers.refresh() == {"lote": 2, "archivos": 1, "anios": [2016]}
    assert gold() == full(a, b)
    # the year that was not touched has the very files it had
    assert _years(root)["2015"] == before["2015"] and _years(root)["2016"] != before["2016"]
    # the file of the second load is replaced by one with another year
    time.sleep(1.1)
    old = [f for f in _files(f"{root}/landing/b")][0]
    c = [{"ANIO": "2018"}, {"ANIO": "2018", "ESTADO": "Cerrados"}]
    land("new", c)
    os.replace([f for f in _files(f"{root}/landing/new")][0], old)
    for crc in (os.path.join(os.path.dirname(old), f".{os.path.basename(old)}.crc"),):
        if os.path.exists(crc):
            os.remove(crc)
    got = layers.refresh()
    assert got["lote"] == 3 and got["anios"] == [2016, 2018]
    assert gold() == full(a, c)
    assert layers.cube().where("anio = 2016").agg(F.sum("quejas")).first()[0] == 1


def test_a_failed_load_is_done_again(spark):
    root = scratch_root(spark, "incremental-test").removeprefix("file:")
    layers = IncrementalLayers(spark, f"{root}/landing", f"{root}/layers")
    _raw(spark, [{"ANIO": "2015"}, {"ANIO": "2017"}]).coalesce(1).write.parquet(f"{root}/landing/a")
    layers._overwrite, write = (lambda df, name, by: write(df, name, by) if name != "manifiesto" else 1 / 0), layers._overwrite
    try:
        layers.refresh()
    except ZeroDivisionError:
        pass
    layers._overwrite = write
    assert layers.silver().count() == 0
    assert layers.refresh()["lote"] == 1
    assert layers.silver().count() == 2 and layers.cube().agg(F.sum("quejas")).first()[0] == 2


def test_gold_tables_are_built_together(spark, monkeypatch):
    root = scratch_root(spark, "incremental-test").removeprefix("file:")
    layers = IncrementalLayers(spark, f"{root}/landing", f"{root}/layers")
    _raw(spark, [{"ANIO": "2015"}, {"ANIO": "2017"}]).coalesce(1).write.parquet(f"{root}/landing/a")
    lock, running, most, write = threading.Lock(), [], [], incremental.write_layer

    def slow(df, path):
        with lock:
            running.append(path)
            most.append(len(running))
        time.sleep(1)
        write(df, path=path)
        with lock:
            running.remove(path)
    monkeypatch.setattr(incremental, "write_layer", slow)
    assert layers.refresh()["anios"] == [2015, 2017]
    assert len(most) == 5 and max(most) > 1
    kpis = spark.read.parquet(f"{root}/layers/dashboard_kpis")
    assert kpis.count() == 6
