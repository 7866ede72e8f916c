"""Column-expression builders (all JVM-side, no Python UDFs)."""

from medalla.functions.scalar import (
    categorize,
    fill_unspecified,
    is_marker,
    month_key,
    month_start,
    normalize_month,
    normalize_year,
    parse_code,
    pct,
    quarter_label,
    standardize_name,
    trend_label,
    volume_band,
)

__all__ = [
    "categorize", "fill_unspecified", "is_marker", "month_key", "month_start",
    "normalize_month", "normalize_year", "parse_code", "pct", "quarter_label",
    "standardize_name", "trend_label", "volume_band",
]
