"""Invariants of the marts, series and reports (the notebooks' manual checks)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from medalla.operators import eda, marts, ranking, series
from medalla.operators.conform import conform
from medalla.schema import SILVER_SCHEMA
from medalla.sources.star import raw_from_star

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def silver(spark):
    return conform(raw_from_star(spark, SF_SMALL)).cache()


def test_totals_agree(silver):
    n = silver.count()
    assert marts.entity_metrics(silver, rank=False).agg(F.sum("total_quejas")).first()[0] == n
    assert marts.product_metrics(silver).agg(F.sum("total_quejas")).first()[0] == n
    assert marts.monthly_metrics(silver).agg(F.sum("total_quejas")).first()[0] == n
    r = ranking.rankings(silver).filter("ranking_tipo = 'total_quejas'")
    assert r.agg(F.sum("total_quejas")).first()[0] == n


def test_ranks_have_no_gaps(silver):
    e = marts.entity_metrics(silver)
    n = e.count()
    assert e.agg(F.min("ranking_quejas"), F.max("ranking_quejas"), F.countDistinct("ranking_quejas")).first() == (1, n, n)
    r = ranking.rankings(silver)
    for row in r.groupBy("ranking_tipo").agg(F.count("*").alias("n"), F.max("posicion").alias("m")).collect():
        assert row.n == row.m


def test_percentages_sum_to_100(silver):
    s = marts.product_metrics(silver).agg(F.sum("porcentaje_total")).first()[0]
    assert abs(s - 100) < 0.5


def test_date_checks(silver):
    from medalla.operators.quality import date_validation

    assert date_validation(silver).filter("NOT fechas_validas").count() == 0
    assert silver.filter("fecha_queja IS NULL").count() == 0
    assert silver.filter("upper(trim(producto)) = 'NA' OR upper(trim(motivo)) = 'NA'").count() == 0


def test_empty_silver_gives_null_percentages(spark):
    empty = spark.createDataFrame([], SILVER_SCHEMA)
    rows = {r.kpi_nombre: r.kpi_valor for r in marts.kpi_table(empty).collect()}
    assert rows["Total Quejas"] == 0.0
    assert rows["Porcentaje Quejas Bancos"] is None


def _series(spark, values, start=dt.date(2020, 1, 1)):
    rows = []
    y, m = start.year, start.month
    for v in values:
        rows.append((dt.date(y, m, 1), v))
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return spark.createDataFrame(rows, "fecha_queja date, total_quejas long")


def test_one_month_series(spark):
    s = _series(spark, [5])
    assert series.with_trend(s, "total_quejas", "fecha_queja").first().tendencia == "ESTABLE"
    assert series.yearly_series_stats(s).first().desviacion is None


def test_centered_mean_needs_full_frame(spark):
    s = _series(spark, list(range(11)))
    out = series.centered_moving_average(s, "total_quejas", "fecha_queja", 12, "c")
    assert out.filter("c IS NOT NULL").count() == 0
    s = _series(spark, list(range(13)))
    got = [r.c for r in series.centered_moving_average(s, "total_quejas", "fecha_queja", 12, "c")
           .orderBy("fecha_queja").collect()]
    assert got[6] == sum(range(12)) / 12 and got[7] == sum(range(1, 13)) / 12 and got[5] is None


def test_fill_calendar_fills_gaps(spark):
    s = spark.createDataFrame([(dt.date(2020, 1, 1), 3), (dt.date(2020, 4, 1), 4)],
                              "fecha_queja date, total_quejas long")
    out = series.fill_calendar(s, ["total_quejas"]).orderBy("fecha_queja").collect()
    assert [r.total_quejas for r in out] == [3, 0, 0, 4]


def test_forecast_band(spark):
    s = _series(spark, [10, 20, 30, 40, 50, 60, 70, 80])
    f = series.forecast_mean(s).orderBy("paso").collect()
    assert [r.periodo_mes for r in f] == ["2020-09", "2020-10", "2020-11"]
    assert f[0].prediccion == 55.0 and f[0].intervalo_inferior < 55.0 < f[0].intervalo_superior


def test_histogram_min_equals_max(spark):
    df = spark.createDataFrame([(7,), (7,), (7,)], "x long")
    h = eda.histogram(df, "x", 10).orderBy("bin").collect()
    assert len(h) == 10 and sum(r.frecuencia for r in h) == 3
    assert h[0].limite_inferior == 6.5 and h[-1].limite_superior == 7.5


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    h = eda.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r.frecuencia for r in h] == [1] * 9 + [2]


def test_tie_break_is_by_key(spark):
    rows = [(1, "B", "BANCO", "p", "m", "VIGENTES", dt.date(2020, 1, 1), "2020-01"),
            (2, "A", "BANCO", "p", "m", "VIGENTES", dt.date(2020, 1, 1), "2020-01")]
    s = spark.createDataFrame(rows, "codigo_entidad int, nombre_entidad string, tipo_entidad_desc string, "
                                    "producto string, motivo string, estado string, fecha_queja date, "
                                    "periodo_mes string")
    e = {r.codigo_entidad: r.ranking_quejas for r in marts.entity_metrics(s).collect()}
    assert e == {1: 1, 2: 2}


def test_hot_entity_matches_pandas(spark, silver):
    """One entity holding over a third of all rows: the mart equals a plain
    pandas group-by and the ranks stay gapless."""
    first = silver.select("nombre_entidad").orderBy("nombre_entidad").first()[0]
    hot = silver.filter(F.col("nombre_entidad") == first)
    skewed = silver
    while skewed.filter(F.col("nombre_entidad") == first).count() * 3 < skewed.count():
        skewed = skewed.unionByName(hot)
    got = marts.entity_metrics(skewed).toPandas().set_index("codigo_entidad")
    pdf = skewed.toPandas()
    exp = pdf.groupby("codigo_entidad").agg(
        total_quejas=("producto", "size"), productos_distintos=("producto", "nunique"),
        motivos_distintos=("motivo", "nunique"), meses_con_quejas=("periodo_mes", "nunique"))
    for c in exp.columns:
        assert (got.loc[exp.index, c].astype(int) == exp[c]).all(), c
    assert sorted(got.ranking_quejas) == list(range(1, len(got) + 1))
    top = got.sort_values("ranking_quejas").iloc[0]
    assert top.nombre_entidad == first


def _silver_rows(spark, rows):
    from medalla.operators.conform import conform
    from medalla.schema import RAW_SCHEMA

    return conform(spark.createDataFrame(rows, RAW_SCHEMA))


def test_entity_absent_from_recent_year(spark):
    s = _silver_rows(spark, [
        ("2.019", "5", "1", "7", "Banco Uno", "Ahorro", "Fraude", "VIGENTES"),
        ("2.020", "6", "1", "7", "Banco Uno", "Ahorro", "Fraude", "VIGENTES"),
        ("2.019", "6", "5", "9", "Seguros Tres", "Vida", "Cobro", "RECIBIDOS"),
    ])
    r = {(x.ranking_tipo, x.nombre_entidad): x.posicion for x in ranking.rankings(s).collect()}
    assert ("quejas_2020", "BANCO UNO") in r
    assert ("quejas_2020", "SEGUROS TRES") not in r
    assert r[("total_quejas", "BANCO UNO")] == 1 and r[("total_quejas", "SEGUROS TRES")] == 2
    fixed = {(x.ranking_tipo, x.nombre_entidad) for x in ranking.rankings(s, recent_year=2019).collect()}
    assert ("quejas_2019", "SEGUROS TRES") in fixed


def test_type_code_25_is_pension(spark):
    s = _silver_rows(spark, [("2016", "1", "25", "3", "Fondo X", "Cesantias", "Demora", "VIGENTES")])
    assert s.first().tipo_entidad_desc == "PENSION Y CESANTIAS"


def test_empty_table_through_every_mart(spark):
    from medalla.operators import analysis

    empty = spark.createDataFrame([], SILVER_SCHEMA)
    ent = marts.entity_metrics(empty, rank=False)
    assert marts.entity_metrics(empty).count() == 0
    assert marts.product_metrics(empty).count() == 0
    assert ranking.rankings(empty).count() == 0
    assert marts.monthly_metrics(empty).count() == 0
    assert eda.describe_metrics(ent).count() == 0
    assert analysis.pareto(ent).count() == 0
    assert eda.histogram(ent, "total_quejas", 5).agg(F.sum("frecuencia")).first()[0] == 0


def test_approx_distinct_counts_are_close(silver):
    exact = marts.entity_metrics(silver, rank=False).toPandas().set_index("codigo_entidad")
    approx = marts.entity_metrics(silver, rank=False, approx=True).toPandas().set_index("codigo_entidad")
    for c in ("productos_distintos", "motivos_distintos", "meses_con_quejas"):
        rel = (approx[c] - exact.loc[approx.index, c]).abs() / exact.loc[approx.index, c]
        assert rel.max() <= 0.05, c
    assert (approx.total_quejas == exact.loc[approx.index, "total_quejas"]).all()
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        marts.entity_metrics(silver, rank=False, approx=True).explain()
    assert "Expand" not in buf.getvalue()


def test_pareto_top_share(spark):
    from medalla.operators import analysis

    ent = spark.createDataFrame(
        [(i, f"E{i}", "BANCO", t) for i, t in enumerate([50, 30, 10, 5, 5, 0], start=1)],
        "codigo_entidad int, nombre_entidad string, tipo_entidad_desc string, total_quejas long")
    curve = {r.nombre_entidad: (r.posicion, r.acumulado, r.porcentaje_acumulado)
             for r in analysis.pareto(ent).collect()}
    assert curve["E1"] == (1, 50, 50.0) and curve["E2"] == (2, 80, 80.0) and curve["E6"] == (6, 100, 100.0)
    s = analysis.pareto_summary(ent).first()
    # ceil(6 * 20 / 100) = 2 entities hold 80 % of the complaints
    assert (s.entidades, s.entidades_top, s.porcentaje_quejas_top) == (6, 2, 80.0)


def test_reports_come_sorted(spark):
    from medalla.operators import quality
    from medalla.sources.star import raw_from_star

    raw = raw_from_star(spark, SF_SMALL)
    silver = conform(raw)
    for df, key in ((marts.yearly_distribution(raw), lambda r: (r.anio is not None, r.anio or 0)),
                    (marts.share_by(raw, "TIPO_ENTIDAD"), lambda r: (-r.total_quejas, r.TIPO_ENTIDAD)),
                    (quality.null_profile(raw), lambda r: (-r.valores_nulos, r.columna)),
                    (quality.date_validation(silver), lambda r: r.anio),
                    (marts.monthly_metrics(silver), lambda r: r.fecha_queja)):
        rows = df.collect()
        assert rows == sorted(rows, key=key) and len(rows) > 1
