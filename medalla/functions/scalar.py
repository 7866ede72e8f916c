"""Scalar column functions of the conform step and the reports.

Each builder takes column names or Columns and returns a Column, so every
rule stays inside Catalyst (constant folding, whole-stage codegen).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from medalla.schema import (
    CLUSTER_LABELS,
    CODE_FORM,
    ENTITY_TYPE_CATEGORIES,
    ENTITY_TYPE_DEFAULT,
    NA_MARKERS,
    NAME_SUFFIX_LTDA,
    NAME_SUFFIX_SA,
    TREND_DOWN,
    TREND_FLAT,
    TREND_UP,
    UNSPECIFIED,
    VOLUME_BAND_EDGES,
    YEAR_DOTTED,
    YEAR_PLAIN,
    YEAR_RANGE,
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize_year(c) -> Column:
    """Year from raw text: '2016', '2.016', '2,016' and '2016.0' give 2016,
    '2.02' (a re-stringified 2.020) gives 2020; anything else gives NULL.

    One digit with up to three decimals is a thousands-dotted year, four
    digits with zero decimals a plain one; the result must lie in
    [1900, 2100].
    """
    t = F.regexp_replace(F.trim(_c(c).cast("string")), ",", ".")
    year = (F.when(t.rlike(YEAR_DOTTED), F.round(t.try_cast("double") * 1000).cast("int"))
             .when(t.rlike(YEAR_PLAIN), F.substring(t, 1, 4).cast("int")))
    return F.when(year.between(*YEAR_RANGE), year)


def parse_code(c) -> Column:
    """Integer code from raw text, zero decimals allowed ('3', '03', '3.0');
    'NA', blanks, non-integers and values beyond an int give NULL."""
    t = F.trim(_c(c).cast("string"))
    return F.when(t.rlike(CODE_FORM), F.regexp_extract(t, CODE_FORM, 1).try_cast("int"))


def normalize_month(c) -> Column:
    """Month number from raw text (NULL when not an integer)."""
    return parse_code(c)


def is_marker(c, markers: Iterable[str] = NA_MARKERS) -> Column:
    """True where upper(trim(c)) is one of the missing-value markers."""
    return F.upper(F.trim(_c(c))).isin(*markers)


def fill_unspecified(c, markers: Iterable[str] = NA_MARKERS, default: str = UNSPECIFIED) -> Column:
    """Trimmed value, or ``default`` where the value is NULL or a marker."""
    col = _c(c)
    return F.when(is_marker(col, markers) | col.isNull(), F.lit(default)).otherwise(F.trim(col))


def standardize_name(c) -> Column:
    """Upper-case name without a trailing ' S.A.' and then a trailing ' LTDA'."""
    up = F.upper(_c(c))
    return F.trim(F.regexp_replace(F.regexp_replace(up, NAME_SUFFIX_SA, ""), NAME_SUFFIX_LTDA, ""))


def month_start(year, month) -> Column:
    return F.make_date(_c(year), _c(month), F.lit(1))


def month_key(year, month) -> Column:
    """'YYYY-MM'."""
    return F.concat(_c(year).cast("string"), F.lit("-"), F.lpad(_c(month).cast("string"), 2, "0"))


def quarter_label(date) -> Column:
    """'Q1'..'Q4'."""
    return F.concat(F.lit("Q"), F.quarter(_c(date)).cast("string"))


def categorize(c, mapping: Sequence = ENTITY_TYPE_CATEGORIES,
               default: str = ENTITY_TYPE_DEFAULT) -> Column:
    """Map codes to labels with a CASE chain; ``mapping`` is
    ``[(codes, label), ...]`` checked in order."""
    col = _c(c)
    expr = None
    for codes, label in mapping:
        cond = col.isin(*codes) if len(codes) > 1 else (col == codes[0])
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def pct(num, den, scale: int = 2) -> Column:
    """round(num * 100 / den, scale); NULL (not an error) when den is 0."""
    return F.round(F.try_divide(_c(num) * F.lit(100.0), _c(den)), scale)


def trend_label(current, previous) -> Column:
    """AUMENTO / DISMINUCION against the previous value, else ESTABLE
    (also when there is no previous value)."""
    cur, prev = _c(current), _c(previous)
    return (F.when(cur > prev, F.lit(TREND_UP))
             .when(cur < prev, F.lit(TREND_DOWN))
             .otherwise(F.lit(TREND_FLAT)))


def volume_band(c, edges: Sequence[int] = VOLUME_BAND_EDGES,
                labels: Sequence[str] | None = None) -> Column:
    """Volume bands [0, e1), [e1, e2), ..., [e(N-1), eN], (eN, inf): the top
    band starts above the last edge."""
    labels = list(labels or CLUSTER_LABELS)
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    col = _c(c)
    expr = F.when(col < edges[0], F.lit(labels[0]))
    for i in range(1, len(edges)):
        inside = (col <= edges[i]) if i == len(edges) - 1 else (col < edges[i])
        expr = expr.when(inside, F.lit(labels[i]))
    return expr.when(col > edges[-1], F.lit(labels[-1]))
