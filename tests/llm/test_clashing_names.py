"""Columns of a user whose names an operator might use inside are carried."""

import pytest

from medalla.llm import decontaminate, lang_id, line_dedup, suffix_dedup

NAMES = ["_key", "_d", "_k", "key", "row", "id", "h", "t", "d", "at", "w", "m", "_w", "_m", "_at", "_lid", "_lang", "lang2",
         "middle", "strays", "_sha", "_kept_sha", "all", "first", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    text = "a passage that is long enough to stand in two documents of this small table, word by word " * 4
    rows = [(1, text, "en"), (2, text, "en"), (3, None, None), (4, "", None), (5, "something else here", "en"), (None, text, "en")]
    return spark.createDataFrame([(*r, *(f"{n}{i}" for n in NAMES)) for i, r in enumerate(rows)],
                                 ", ".join(["doc_id long", "text string", "lang string", *(f"`{n}` string" for n in NAMES)]))


def carried(docs, out):
    cols = [f"`{n}`" for n in ["doc_id", *NAMES]]
    key = lambda r: (r.doc_id is None, r.doc_id or 0)
    assert sorted(map(tuple, docs.select(cols).collect()), key=str) == sorted(map(tuple, out.select(cols).collect()), key=str)
    return sorted(out.collect(), key=key)


def test_line_dedup(docs):
    got = carried(docs, line_dedup.dedup_lines(docs))
    assert [r.n_removed for r in got] == [0, 1, 0, 0, 0, 1]


def test_decontaminate(spark, docs):
    items = spark.createDataFrame([("x", "passage that is long enough to stand in two documents of")], "item_id string, text string")
    got = carried(docs, decontaminate.contamination(docs, items))
    assert [r.contaminated for r in got] == [True, True, False, False, False, True]


def test_suffix_dedup(docs):
    got = carried(docs, suffix_dedup.remove_repeats(docs))
    assert [r.n_removed > 0 for r in got] == [True, True, False, False, False, True]
    assert bytes(got[4].kept) == b"something else here"


def test_lang_id(spark, docs):
    got = carried(docs, lang_id.identify(spark, docs))
    assert [r.lang_pred for r in got[:4]][2:] == ["und", "und"]


def test_lines_of_one_hash_are_not_merged(spark, monkeypatch):
    """Every id clashes: only equal lines count as one."""
    real = line_dedup.lines_of
    monkeypatch.setattr(line_dedup, "lines_of", lambda d, least=1: real(d, least).selectExpr(
        "doc_id", "key", "line_no", "7L as id", "id2", "line"))
    df = spark.createDataFrame([(1, "an apple a day keeps\nthe doctor far away"), (2, "the doctor far away\nnothing alike at all")],
                               "doc_id long, text string")
    got = {r.doc_id: r.removed_lines for r in line_dedup.dedup_lines(df).collect()}
    assert got == {1: [], 2: [0]}
