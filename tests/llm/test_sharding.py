"""Sharding against the law written as SQL, and its edge cases."""

import zlib

import duckdb

from conftest import SF_SMALL
from medalla.llm import queries, sharding

LAW = """
with d as (select doc_id, coalesce(text, '') as t, strlen(coalesce(text, '')) + 1 as size from documents),
b as (select *, md5(t) as k, sum(size) over () as total from d),
c as (select *, coalesce(sum(size) over (order by k, doc_id nulls first
        rows between unbounded preceding and 1 preceding), 0) as before from b)
select doc_id, cast(size as bigint), cast(before * 16 // total as int) from c"""


def gapless(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_query_is_the_law(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_SMALL}/documents.parquet'")
    got = queries.op9_shard(spark, SF_SMALL).collect()
    assert sorted((r.doc_id, r.size, r.shard) for r in got) == sorted(con.execute(LAW).fetchall())
    crc = dict(con.execute("select doc_id, text from documents").fetchall())
    assert all(r.text_crc32 == zlib.crc32((crc[r.doc_id] or "").encode()) for r in got)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    gapless(got)


def test_hot_text_nulls_and_extra_columns(spark):
    rows = [(i, "copy " * 20, i) for i in range(3000)] + [(i, f"text {i}", i) for i in range(3000, 6000)]
    rows += [(None, None, 0), (None, "", 0), (None, None, 0), (7, "x" * 100_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard long")
    out = sharding.shard_by_bytes(df, 8).collect()
    assert len(out) == len(rows)
    gapless(out)
    sizes = [sum(r["size"] for r in out if r.shard == s) for s in range(8)]
    mean = sum(sizes) / 8
    assert all(abs(s - mean) <= 100_001 for s in sizes)
    df = df.where("doc_id <> 7 or doc_id is null")
    out = sharding.shard_by_bytes(df, 8).collect()
    sizes = [sum(r["size"] for r in out if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 2 * 101


def test_tolerance_small_and_empty_tables(spark):
    df = spark.createDataFrame([(i, "t" * (i % 50)) for i in range(5000)], "doc_id long, text string")
    out = sharding.shard_by_bytes(df, 4, tolerance=0.1).collect()
    gapless(out)
    sizes = [sum(r["size"] for r in out if r.shard == s) for s in range(4)]
    assert max(sizes) <= 1.25 * min(sizes)
    few = sharding.shard_by_bytes(df.limit(3), 16).collect()
    assert len(few) == 3
    gapless(few)
    assert sharding.shard_by_bytes(df.limit(0), 16).count() == 0


def test_slots_follow_the_key_and_texts_arrive(spark):
    rows = [(i, f"text {i % 700} " * (i % 9), i, str(i)) for i in range(4000)] + [(None, None, 0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key long, `a.b` string")
    keyed = df.withColumn("k", sharding.sort_key(df.doc_id, df.text)).collect()
    want = [(r.doc_id, r.text, r["_key"], r["a.b"]) for r in sorted(keyed, key=lambda r: r.k)]
    out = sharding.shard_by_bytes(df, 8).collect()
    gapless(out)
    assert [(r.doc_id, r.text, r["_key"], r["a.b"]) for r in sorted(out, key=lambda r: (r.shard, r.slot))] == want
