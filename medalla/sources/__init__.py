"""Sources and sinks: raw CSV, layer tables, the star-schema adapter."""

from medalla.sources.layers import (
    layer_row_counts,
    read_layer,
    read_raw_csv,
    write_layer,
)
from medalla.sources.star import raw_from_star, read_table

__all__ = ["layer_row_counts", "read_layer", "read_raw_csv", "write_layer",
           "raw_from_star", "read_table"]
