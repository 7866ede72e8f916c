"""Quality rules against plain loops, edge cases."""

import random
import re

import numpy as np

from conftest import SF_SMALL
from medalla.llm import quality_rules as q
from medalla.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text)
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = [x for i, x in enumerate(lines) if x in lines[:i]]
    out |= {"n_lines": len(lines), "n_dup_lines": len(dup),
            "dup_line_chars": sum(len(x) for line in dup for x in WORD.findall(line))}
    for n in (3, *q.MOST_IN_NGRAMS):
        wins = [tuple(w[i:i + n]) for i in range(len(w) - n + 1)]
        mine = {i + j for i, x in enumerate(wins) for j in range(n) if (wins.count(x) > 1 if n == 3 else x in wins[:i])}
        out["n_repeat_words" if n == 3 else f"dup_{n}gram_chars"] = len(mine) if n == 3 else sum(len(w[p]) for p in mine)
    return out


def texts():
    r = random.Random(5)
    out = ["", " \t\n", "a", "a a a a a a a a a a a a a", "x\x0by\x1cz w #|<> é 😀\n\n x\x0by\n x\x0by", "a b c " * 30]
    for size in (2, 3, 5, 50):
        for n in (4, 30, 120):
            out.append("".join(r.choice("abcdefé😀xyz"[:size]) + r.choice([" ", " ", "\n", "\t"]) for _ in range(n)))
    return out


def test_counts_against_loops():
    got = q.measure(texts())
    for i, t in enumerate(texts()):
        assert {c: int(got[c][i]) for c in q.COUNTS} == brute(t), t


def test_hash_collisions_are_confirmed():
    ids = np.array([0, 1, 2, 0, 1, 2, 3, 4, 5, 0, 1])
    doc = np.array([0] * 9 + [1] * 2)
    at = np.array([0, 1, 3, 4, 6, 9])
    pos, later = q.repeated_windows(ids, doc, 2, np.zeros(len(at), dtype=np.uint64), at)
    assert dict(zip(pos.tolist(), later.tolist())) == {0: False, 3: True, 1: False, 4: True}


def test_blocks_do_not_matter(monkeypatch):
    whole = q.measure(texts())
    parts = [q.measure([t]) for t in texts()]
    for c in q.COUNTS:
        assert [int(p[c][0]) for p in parts] == whole[c].tolist()


def test_edge_cases(spark):
    clean = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"w{i}" for i in range(200_000))
    repeated = clean + "\n" + clean
    rows = [(1, None, 7), (2, "", 7), (3, clean, 7), (3, clean, 7), (None, repeated, 7), (4, long, 7), (5, "a " * 500_000, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int").withColumnRenamed("kept", "n_words")
    out = {(r.doc_id, len(r.text or "")): r for r in q.quality(df.selectExpr("*", "1 as `quality counts`")).collect()}
    assert len(out) == 6 and q.quality(df).count() == 7
    assert [out[1, 0][c] for c in q.COUNTS] == [0] * len(q.COUNTS) and out[1, 0].base_failed and not out[2, 0].kept
    assert out[3, len(clean)].kept and out[4, len(long)].kept and out[4, len(long)].n_words == 200_000
    twice = out[None, len(repeated)]
    assert twice.base_failed and not twice.kept and twice.n_dup_lines == 1 and twice.dup_10gram_chars == twice.dup_line_chars
    assert out[5, 1_000_000].n_repeat_words == 500_000
    assert q.quality(df.limit(0)).count() == 0


def test_verdict_beyond_the_base_rule(spark):
    some = " ".join(f"w{i}" for i in range(12))
    text = some + " " + " ".join(f"x{i}" for i in range(60)) + " " + some
    r = q.quality(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert not r.base_failed and not r.kept


def test_query_against_loops(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in queries.op13_quality_rules(spark, SF_SMALL).collect():
        if len(docs[r.doc_id]) < 4000:
            want = brute(docs[r.doc_id])
            assert {c: r[c] for c in want if c in r} == {c: v for c, v in want.items() if c in r}
            assert r.base_failed == (want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"])
