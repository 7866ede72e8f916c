"""Golden raw rows -> expected clean rows and reject reasons."""

import datetime as dt

from medalla.operators.conform import conform, rejects
from medalla.schema import RAW_SCHEMA

# (ANIO, MES, TIPO_ENTIDAD, CODIGO_ENTIDAD, NOMBRE_ENTIDAD, PRODUCTO, MOTIVO, ESTADO)
GOLDEN_RAW = [
    ("2.016", "3", "1", "7", "Banco Uno S.A.", " Tarjetas de crédito ", "Fraude", "vigentes"),
    ("2.020", "12", "23", "2", "Pensiones Dos s.a", "NA", "na", " Recibidos "),
    ("2016", "1", "5", "9", "Seguros Tres Ltda.", None, "Cobro", "CERRADOS"),
    ("2,015", "07", "2", "4", "Corp Cuatro LTDA. S.A.", " na ", None, "VIGENTES"),
    ("2.02", "4", "7", "5", "Fidu Cinco S.A. Ltda", "Ahorro", "Demora", "RECIBIDOS"),
    ("2.0", "2", "99", "8", " Coop Seis S.A.S ", "Crédito", "Trato", None),
    ("2.017", "13", "1", "7", "Banco Uno S.A.", "Ahorro", "Fraude", "VIGENTES"),
    ("NA", "5", "1", "7", "Banco Uno S.A.", "Ahorro", "Fraude", "VIGENTES"),
    ("2.018", "NA", "1", "7", "Banco Uno S.A.", "Ahorro", "Fraude", "VIGENTES"),
    ("2.019", "6", " na ", "7", "Banco Uno S.A.", "Ahorro", "Fraude", "VIGENTES"),
    ("2.019", "6", "1", None, "Banco Uno S.A.", "Ahorro", "Fraude", "VIGENTES"),
    (None, "6", "1", "7", "Banco Uno S.A.", "Ahorro", "Fraude", "VIGENTES"),
]

D = dt.date
EXPECTED_CLEAN = {
    (1, 7, "BANCO UNO", "Tarjetas de crédito", "Fraude", "VIGENTES", 2016, 3, D(2016, 3, 1), "2016-03", "Q1", "BANCO"),
    (23, 2, "PENSIONES DOS", "NO ESPECIFICADO", "NO ESPECIFICADO", "RECIBIDOS", 2020, 12, D(2020, 12, 1), "2020-12",
     "Q4", "PENSION Y CESANTIAS"),
    (5, 9, "SEGUROS TRES", "NO ESPECIFICADO", "Cobro", "CERRADOS", 2016, 1, D(2016, 1, 1), "2016-01", "Q1", "SEGUROS"),
    (2, 4, "CORP CUATRO", "NO ESPECIFICADO", "NO ESPECIFICADO", "VIGENTES", 2015, 7, D(2015, 7, 1), "2015-07", "Q3",
     "CORPORACION FINANCIERA"),
    (7, 5, "FIDU CINCO S.A.", "Ahorro", "Demora", "RECIBIDOS", 2020, 4, D(2020, 4, 1), "2020-04", "Q2",
     "SOCIEDADES FIDUCIARIAS"),
    (99, 8, "COOP SEIS S.A.S", "Crédito", "Trato", None, 2000, 2, D(2000, 2, 1), "2000-02", "Q1",
     "OTRA ENTIDAD FINANCIERA"),
}


def _raw(spark):
    return spark.createDataFrame(GOLDEN_RAW, RAW_SCHEMA)


def test_golden_clean_rows(spark):
    out = conform(_raw(spark))
    assert out.columns[:3] == ["tipo_entidad_id", "codigo_entidad", "nombre_entidad"]
    assert {tuple(r) for r in out.collect()} == EXPECTED_CLEAN


def test_golden_rejects(spark):
    rows = rejects(_raw(spark)).select("ANIO", "MES", "motivo_rechazo").collect()
    got = sorted((r.ANIO or "", r.MES, r.motivo_rechazo) for r in rows)
    assert got == sorted([
        ("2.017", "13", "MES_INVALIDO"),
        ("NA", "5", "ANIO_INVALIDO"),
        ("2.018", "NA", "MES_INVALIDO"),
        ("2.019", "6", "TIPO_ENTIDAD_INVALIDO"),
        ("2.019", "6", "CODIGO_ENTIDAD_INVALIDO"),
        ("", "6", "ANIO_INVALIDO"),
    ])


def test_accepted_plus_rejected_is_raw(spark):
    from medalla.sources.star import raw_from_star

    raw = raw_from_star(spark, "/root/testdata/sf0.001")
    assert conform(raw).count() + rejects(raw).count() == raw.count()


def test_stamp_column(spark):
    out = conform(_raw(spark), stamp=True)
    assert out.columns[-1] == "fecha_procesamiento"
    assert out.filter("fecha_procesamiento IS NULL").count() == 0


def test_corrupt_lines_are_rejected_first(spark, tmp_path):
    from medalla.sources.layers import read_raw_csv

    path = tmp_path / "raw.csv"
    path.write_text("ANIO,MES,TIPO_ENTIDAD,CODIGO_ENTIDAD,NOMBRE_ENTIDAD,PRODUCTO,MOTIVO,ESTADO\n"
                    "2016,3.0,1,7,Banco Uno,Ahorro,Fraude,VIGENTES\n"
                    "2016,3,1,7,Banco Uno, S.A.,Ahorro,Fraude,VIGENTES\n"
                    "2016,3,1\n"
                    "16,3,1,7,Banco Uno,Ahorro,Fraude,VIGENTES\n")
    raw = read_raw_csv(spark, str(path))
    ok, bad = conform(raw).collect(), rejects(raw).collect()
    assert [(r.anio, r.mes, r.producto) for r in ok] == [(2016, 3, "Ahorro")]
    assert sorted(r.motivo_rechazo for r in bad) == ["ANIO_INVALIDO", "LINEA_CORRUPTA", "LINEA_CORRUPTA"]
