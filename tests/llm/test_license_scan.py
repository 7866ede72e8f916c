"""Licence scan: automata against a regular expression, base places."""

import re

from conftest import SF_SMALL
from medalla.llm import license_scan as ls
from medalla.llm import queries


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_words():
    for t in ("", "  ", "A-b_C9 ÄÖ, ſ", "x\x00y\x7fz", "cc by-NC 4.0", "İstanbul K"):
        assert [w.decode() for w in ls.words(t)] == words(t)


def test_automata():
    a = ls.compile_template("t", "<<opt>>this <<var 2>> is<<end>> under the <<opt>>old<<end>> mit license")
    as_re = re.compile(r"(?:this (?:\w+ ){0,2}?is )?under the (?:old )?mit license\b")
    for t in ("under the mit license", "this is under the mit license", "this my work is under the old mit license x",
              "this a b c is under the mit license", "under the older mit license", "under the mit", "mit license"):
        w = ls.words(t)
        ends = [a.match(w, i) for i in range(len(w)) if w[i] in a.first]
        m = as_re.match(t)
        want = len(m[0].split()) if m else -1
        assert max([*(e for i, e in zip((i for i in range(len(w)) if w[i] in a.first), ends) if i == 0), -1]) == want, t
    full = ls.TEMPLATES["mit-text"].replace("<<var 12>>", "2020 some one").replace("<<opt>>", "").replace("<<end>>", "")
    got = [x for x in map(lambda t: ls.compile_template(*t), ls.TEMPLATES.items())
           for i, w in enumerate(ls.words(full)) if w in x.first and x.match(ls.words(full), i) >= 0]
    assert {x.label for x in got} == {"mit-text"}


def test_edge_cases(spark):
    long = "word " * 50000 + "MIT  License " + "x " * 50000
    rows = [(1, None, 5), (2, "", 5), (3, "Released under the MIT License. MIT-license; CC BY-NC 4.0", 5),
            (None, "gnu general public License gnu general public license", 5), (4, long, 5), (4, long, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words long")
    out = ls.scan(df, ls.PHRASES | ls.TEMPLATES).collect()
    assert [r.n_words for r in out[:3]] == [0, 0, 12]
    assert out[0].matches == [] and out[1].matches == []
    assert {(m.label, m.start) for m in out[2].matches} == {("mit-notice", 0), ("mit-notice", 1), ("mit", 3), ("mit", 5), ("cc-by", 7)}
    assert [(m.label, m.start, m.end) for m in out[3].matches] == [("gpl", 0, 4), ("gpl", 4, 8)]
    assert [(m.label, m.start) for m in out[4].matches] == [("mit", 50000)]
    assert ls.scan(df.limit(0), ls.PHRASES).count() == 0


def test_query_against_brute_force(spark):
    docs = {r.doc_id: words(r.text or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in queries.op6_license_scan(spark, SF_SMALL).collect():
        w = docs[r.doc_id]
        at = {(label, i) for label, p in ls.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()}
        assert r.n_words == len(w) and r.n_base == len(at)
        assert r.first_word == min((i for _, i in at), default=None)
        assert r.last_word == max((i for _, i in at), default=None)
        assert r.base_labels == ",".join(sorted({x for x, _ in at}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
