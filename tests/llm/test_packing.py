"""Packing: ids as the tokenizer gives them, gapless sequences, few of them."""

import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from medalla.llm import packing

TOK = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_ids_equal_the_tokenizers_library(text):
    slow = Tokenizer.from_file(TOK)
    slow.encode_special_tokens = True
    assert packing.encoder(TOK).encode_ordinary(text) == slow.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_sum_of_squares_is_the_greedy_of_its_definition(lengths):
    cap = 20
    bins, offsets, made = packing.sum_of_squares(np.array(lengths, dtype=np.int64), cap)
    gaps: list[int] = []  # open or closed bins, in order of opening
    for s, b, o in zip(lengths, bins, offsets):
        def total(new_gaps):
            return sum(new_gaps.count(g) ** 2 for g in range(1, cap))
        options = {}
        for i, g in enumerate(gaps):
            if g >= s:
                options[("old", g)] = total(gaps[:i] + [g - s] + gaps[i + 1:])
        options[("new", cap)] = total(gaps + [cap - s])
        best = min(options.values())
        kind = "new" if b == len(gaps) else "old"
        gap = cap if kind == "new" else gaps[b]
        assert o == cap - gap and options[(kind, gap)] == best
        if kind == "new":
            gaps.append(cap - s)
        else:
            gaps[b] -= s
    assert made == len(gaps)


def check(pieces, docs, capacity):
    slow = Tokenizer.from_file(TOK)
    slow.encode_special_tokens = True
    ids = {}
    for d, t in docs:
        ids.setdefault(d, []).append([*slow.encode(t or "", add_special_tokens=False).ids, 0])
    by_seq = {}
    for r in pieces:
        by_seq.setdefault(r.sequence_id, []).append(r)
        whole = [x for x in ids[r.doc_id] if zlib.crc32(
            np.array(x[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32]
        assert whole
        assert r.length == capacity or r.start == 0 and len(whole[0]) % capacity == r.length % capacity
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    total = sum(r.length for r in pieces)
    assert total == sum(len(x) for v in ids.values() for x in v)
    return len(by_seq), -(-total // capacity)


def test_edge_cases(spark):
    rows = [(1, "a b c"), (2, None), (3, ""), (1, "a b c"), (None, "x"), (4, "word " * 9000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, offset int")
    out = packing.pack(packing.tokenize_pieces(docs, TOK, 64), 64).collect()
    n, least = check(out, rows, 64)
    assert n <= least + 1
    assert packing.pack(packing.tokenize_pieces(docs.limit(0), TOK)).count() == 0


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    pieces = packing.tokenize_pieces(docs, TOK, with_ids=False)
    out = packing.pack(pieces, per_group=100).collect()
    rows = [tuple(r) for r in docs.collect()]
    n, least = check(out, rows, 2048)
    assert n <= 1.2 * least  # groups of a hundred pieces
    n, least = check(packing.pack(pieces).collect(), rows, 2048)
    assert n <= 1.05 * least
    assert packing.tokenize_pieces(docs, TOK).where(F.octet_length("ids") != 4 * F.col("length")).count() == 0


def test_packed_rows_hold_the_ids(spark):
    rows = [(1, "a b c " * 40), (2, None), (1, "a b c " * 40), (None, "x y"), (4, "word " * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = packing.pack(packing.tokenize_pieces(docs, TOK, 64), 64)
    check(packing.described(packed).collect(), rows, 64)
    seqs = packing.sequences(packed).withColumn("ids4", packing.id_array("ids")).persist()
    assert all(r.length == len(r.ids4) <= 64 and r.length == sum(p.length for p in r.parts) for r in seqs.collect())
    n, least = check(packing.unpacked(seqs).collect(), rows, 64)
    assert n <= least + 1


def test_long_runs_of_white_space(spark):
    slow = Tokenizer.from_file(TOK)
    slow.encode_special_tokens = True
    texts = [" " * 2_000_000, "\n" * 1_000_000, "x" + "\t" * 1_000_000 + "y z", " \n" * 500_000, "\u3000" * 400_000, "a " * 50_000]
    for t in texts:
        assert packing.encoder(TOK).encode_ordinary(t) == slow.encode(t, add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = packing.described(packing.pack(packing.tokenize_pieces(docs, TOK))).collect()
    assert sum(r.length for r in out) == sum(len(slow.encode(t, add_special_tokens=False).ids) + 1 for t in texts)


def test_repeated_rows_spread_over_groups(spark):
    docs = spark.createDataFrame([(7, "same text")] * 400, "doc_id long, text string")
    out = packing.pack(packing.tokenize_pieces(docs, TOK, 64), 64, per_group=50)
    assert out.select(F.shiftright("sequence_id", 40).alias("g")).groupBy("g").count().agg(F.max("count")).first()[0] < 100
