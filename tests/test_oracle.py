"""Every registered query with SQL equals DuckDB at sf0.01; the others run."""

import os

import pytest

import __spark_entry__ as E
from medalla.plans import registry
from oracle_check import compare, duck_connection

from conftest import SF_ORACLE, SF_SMALL

os.environ.setdefault("ORACLE_EXACT", "1")

@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF_ORACLE, con)
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ranking_quejas" in df.columns


def test_registry_covers_oracles():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_output_column_names_are_unique(spark):
    for name, q in registry.QUERIES.items():
        cols = q(spark, SF_SMALL).columns
        assert len({c.lower() for c in cols}) == len(cols), (name, cols)
