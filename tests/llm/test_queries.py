"""The registered queries: SQL where there is some, else columns and counts."""

import os

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from medalla.llm import queries
from oracle_check import compare, duck_connection

os.environ.setdefault("ORACLE_EXACT", "1")

COLUMNS = {
    "op1_lang_id": "doc_id held_out lang_pred score",
    "op5_pack": "doc_id piece start length ids_crc32 sequence_id offset",
    "op6_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op7_line_dedup": "doc_id n_lines n_removed removed_lines",
    "op9_shard": "doc_id size text_crc32 law shard slot grown_shard",
    "op10_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op11_conversation_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, SF_ORACLE, duck_connection(SF_ORACLE))
    assert r["status"] == "ok", r


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    assert df.columns[:len(COLUMNS[name].split())] == COLUMNS[name].split()
    if name not in ("op5_pack", "op11_conversation_repair"):
        assert df.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(COLUMNS) | set(queries.SQL) == set(queries.QUERIES)
