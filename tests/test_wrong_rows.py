"""Inputs that once gave wrong rows: extreme doubles, NaN, a nameless entity."""

import math

from medalla.operators import analysis as A
from medalla.operators import eda as E


def test_describe_extreme_doubles(spark):
    df = spark.createDataFrame([(1e30, 1e-12, 0.1, float("nan")), (3e30, 3e-12, 0.2, 1.0)], "big double, small double, few double, odd double")
    got = {r.metrica: r for r in E.describe_metrics(df, df.columns, scale=None).collect()}
    assert got["big"].media == 2e30 and abs(got["small"].media - 2e-12) < 1e-24
    assert got["few"].media == 0.15 and math.isnan(got["odd"].media)
    assert {r.metrica: r.media for r in E.describe_metrics(df, ["few", "big"]).collect()} == {"few": 0.15, "big": 2e30}


def test_histogram_with_nan_and_infinities(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 1.0, 2.0, 4.0, float("nan"), float("inf"), -math.inf, None)], "v double")
    got = sorted(((r.bin, r.limite_inferior, r.limite_superior, r.frecuencia) for r in E.histogram(df, "v", 4).collect()), key=str)
    assert got == [(0, 0.0, 1.0, 1), (1, 1.0, 2.0, 1), (2, 2.0, 3.0, 1), (3, 3.0, 4.0, 1), (None, None, None, 3)]


def test_entity_without_a_name(spark):
    rows = [(None, "p", "2020-01", 1)] * 4 + [(None, None, "2020-02", 2), ("b", "p", "2020-01", 1)]
    df = spark.createDataFrame(rows, "nombre_entidad string, producto string, periodo_mes string, fecha_queja int")
    products = [tuple(r) for r in A.entity_products(df).collect()]
    assert products == [(None, "p", 4, 5, 80.0, 80.0), (None, None, 1, 1, 100.0, 20.0)]
    months = {r.periodo_mes: (r.nombre_entidad, r.quejas_entidad, r.quejas_mercado) for r in A.entity_drilldown(df).collect()}
    assert months == {"2020-01": (None, 4, 5), "2020-02": (None, 1, 1)}
