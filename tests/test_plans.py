"""Plan shapes the scale design relies on (checked on the physical plan)."""

import contextlib
import io

from pyspark.sql import functions as F

from medalla.operators import marts, text
from medalla.operators.conform import conform
from medalla.plans.layers import silver_layer
from medalla.sources.star import raw_from_star, read_table

from conftest import SF_SMALL


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_top_k_per_group_is_limited_before_the_shuffle(spark):
    df = text.term_counts(read_table(spark, SF_SMALL, "documents"), "text", "lang", 5)
    p = _plan(df, "simple")
    assert "WindowGroupLimit" in p and "Partial" in p


def test_year_filter_prunes_silver_folders(spark):
    s = silver_layer(spark, SF_SMALL)
    p = _plan(s.filter(F.col("anio") == 1995).groupBy("producto").count())
    assert "PartitionFilters: [isnotnull(anio" in p and "(anio#" in p


def test_scan_reads_only_needed_columns(spark):
    p = _plan(silver_layer(spark, SF_SMALL).groupBy("producto").count())
    assert "ReadSchema: struct<producto:string>" in p


def test_conform_parses_behind_a_generator(spark):
    p = _plan(conform(raw_from_star(spark, SF_SMALL)), "simple")
    assert "Generate explode" in p
    # no parsing is re-evaluated in a filter pushed down to the scans
    assert not [line for line in p.splitlines() if "Filter" in line and "try_cast" in line]


def test_marts_aggregate_partially(spark):
    p = _plan(marts.entity_metrics(silver_layer(spark, SF_SMALL), rank=False), "simple")
    assert "partial_count" in p and "Expand" in p


def test_group_lookup_is_broadcast(spark):
    from medalla.operators.segment import peer_benchmark

    ent = marts.entity_metrics(silver_layer(spark, SF_SMALL), rank=False)
    p = _plan(peer_benchmark(ent), "simple")
    assert "BroadcastHashJoin" in p and "BroadcastExchange" in p


def test_named_entity_filter_reaches_the_scan(spark):
    from medalla.operators.analysis import entity_drilldown

    p = _plan(entity_drilldown(silver_layer(spark, SF_SMALL), entity="SUPPLIER#000000001"))
    pushed = [line for line in p.splitlines() if line.startswith("PushedFilters")]
    assert any("EqualTo(nombre_entidad,SUPPLIER#000000001)" in line for line in pushed)
