"""Column rules: year forms, suffix order, markers, category map, bands."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medalla.functions import scalar as S


def _forms(year: int) -> list[str]:
    """Every raw spelling of a year the conform step must accept."""
    y = str(year)
    dotted = f"{y[0]}.{y[1:]}"
    forms = [y, dotted, f"{y[0]},{y[1:]}", f" {dotted} ", f"{y}.0"]
    trimmed = dotted.rstrip("0")  # 2.020 re-stringified as a double: 2.02
    if trimmed != dotted and not trimmed.endswith("."):
        forms.append(trimmed)
    return forms


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(min_value=1900, max_value=2100), min_size=1, max_size=20))
def test_every_year_form_normalises(spark, years):
    rows = [(f, y) for y in years for f in _forms(y)]
    df = spark.createDataFrame(rows, "raw string, expected int")
    bad = df.filter(~S.normalize_year("raw").eqNullSafe(F.col("expected"))).collect()
    assert not bad, bad


def test_invalid_years_are_null(spark):
    df = spark.createDataFrame([(x,) for x in ["NA", "", " ", "abc", "2016-01", "-2.016", "0", "3000", "16", "99", "0.5", "2.0165",
                                             "2016d", "2016.5", "1.8", "1e3", "NaN", "20160"]] + [(None,)],
                               "raw string")
    assert df.filter(S.normalize_year("raw").isNotNull()).count() == 0


def test_suffix_order(spark):
    cases = {
        "Banco Uno S.A.": "BANCO UNO",
        "Foo LTDA. S.A.": "FOO",
        "Foo S.A. LTDA.": "FOO S.A.",
        "Coop S.A.S": "COOP S.A.S",
        "Bar SA": "BAR SA",
        "  Baz Ltda  ": "BAZ",
    }
    df = spark.createDataFrame(list(cases.items()), "raw string, expected string")
    got = {r.raw: r.n for r in df.select("raw", S.standardize_name("raw").alias("n")).collect()}
    assert got == cases


def test_markers_and_default(spark):
    df = spark.createDataFrame([(" na ",), ("NA",), ("Na",), (None,), (" Ahorro ",), ("NAB",)], "raw string")
    got = [r.v for r in df.select(S.fill_unspecified("raw").alias("v")).collect()]
    assert got == ["NO ESPECIFICADO"] * 4 + ["Ahorro", "NAB"]


def test_category_map(spark):
    codes = [1, 2, 3, 5, 6, 7, 8, 23, 24, 25, 0, 4, 99, None]
    df = spark.createDataFrame([(c,) for c in codes], "c int")
    got = [r.v for r in df.select(S.categorize("c").alias("v")).collect()]
    assert got == ["BANCO", "CORPORACION FINANCIERA", "CORPORACION FINANCIERA", "SEGUROS", "SEGUROS",
                   "SOCIEDADES FIDUCIARIAS", "SOCIEDADES FIDUCIARIAS", "PENSION Y CESANTIAS",
                   "PENSION Y CESANTIAS", "PENSION Y CESANTIAS"] + ["OTRA ENTIDAD FINANCIERA"] * 4


def test_volume_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0, 49, 50, 499, 500, 1999, 2000, 2001, 10**6]], "v long")
    got = [r.b for r in df.select(S.volume_band("v").alias("b")).collect()]
    assert got == ["Bajo Volumen", "Bajo Volumen", "Volumen Medio", "Volumen Medio", "Alto Volumen",
                   "Alto Volumen", "Alto Volumen", "Volumen Crítico", "Volumen Crítico"]


def test_month_key_and_quarter(spark):
    df = spark.createDataFrame([(2016, 3), (2020, 12), (1999, 7)], "y int, m int")
    got = [(r.k, r.q) for r in df.select(S.month_key("y", "m").alias("k"),
                                         S.quarter_label(S.month_start("y", "m")).alias("q")).collect()]
    assert got == [("2016-03", "Q1"), ("2020-12", "Q4"), ("1999-07", "Q3")]


def test_pct_divide_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 3)], "a long, b long")
    got = [r.p for r in df.select(S.pct("a", "b").alias("p")).collect()]
    assert got == [None, 33.33]


def test_codes_allow_zero_decimals(spark):
    cases = {"3": 3, " 03 ": 3, "3.0": 3, "3.": 3, "3.5": None, "NA": None, "": None, "1e1": None, "3d": None,
             "99999999999": None, "-4": -4, None: None}
    df = spark.createDataFrame([(c,) for c in cases], "raw string")
    assert {r.raw: r.n for r in df.select("raw", S.parse_code("raw").alias("n")).collect()} == cases
