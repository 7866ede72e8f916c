"""Decontamination against brute force (the SQL check covers documents)."""

import random
import re

import pytest
from pyspark.sql import functions as F

from medalla.llm import decontaminate as dc


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, n=10):
    wins = {}
    for item, text in items:
        w = words(text)
        for win in ([w[i:i + n] for i in range(len(w) - n + 1)] if len(w) >= n else [w] if w else []):
            wins.setdefault(tuple(win), set()).add("" if item is None else str(item))
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for win, who in wins.items():
            for i in range(len(w) - len(win) + 1):
                if tuple(w[i:i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    ids |= who
        out.append((d, len(w), len(hit), sorted(ids)))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(3)
    v = [f"w{i}" for i in range(30)] + ["the"] * 10 + ["É", "ſ"]
    items = [(i, " ".join(rnd.choice(v) for _ in range(rnd.choice([1, 2, 9, 10, 11, 25])))) for i in range(20)]
    items += [(None, "null item id has ten words or maybe eleven of them"), (77, None), (78, "  "), (5, items[5][1])]
    docs = []
    for i in range(150):
        t = [rnd.choice(v) for _ in range(rnd.randrange(0, 80))]
        if i % 3 == 0:
            t[5:5] = rnd.choice(items[:20])[1].upper().split()
        if i % 10 == 0:
            t += items[20][1].split()[:rnd.choice([9, 10, 11])]
        docs.append((i, " -".join(t)))
    docs += [(900, None), (901, ""), (902, "?!"), (None, items[3][1]), (903, items[3][1]), (903, items[3][1]),
             (904, ("w1 " * 50000) + items[3][1])]
    return docs, items


def test_against_brute_force(spark, tables):
    docs, items = tables
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_ids string")
    it = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, win int")
    got = dc.contamination(df, it).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids) for r in got), key=key) == sorted(brute(docs, items), key=key)
    assert all(r.n_items == len(r.item_ids) and r.contaminated == (r.n_hit > 0) for r in got)
    assert dc.contamination(df.limit(0), it).count() == 0
    none = dc.contamination(df, it.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)


def test_places_and_proximity(spark):
    docs = spark.createDataFrame([("alpha x beta y gamma",), ("gamma beta alpha q q q q alpha beta",), ("alpha beta",)], "text string")
    terms = spark.createDataFrame([("alpha",), ("beta",), ("gamma",)], "term string")
    post = dc.index(docs, terms)
    assert post.count() == 10
    sets = spark.createDataFrame([(1, "alpha"), (1, "beta"), (1, "gamma"), (2, "alpha"), (2, "beta"), (3, "alpha"), (3, "zzz")], "id long, term string")
    key = {r.k: r.text for r in docs.select(dc.text_key("text").alias("k"), "text").collect()}

    def near(span):
        return {(r.id, key[r.key].split()[0], r.start) for r in dc.proximity_places(post, sets, span).collect()}
    assert near(5) == {(1, "alpha", 0), (1, "gamma", 0), (2, "alpha", 0), (2, "gamma", 1), (2, "gamma", 7)}
    assert near(3) == {(1, "gamma", 0), (2, "alpha", 0), (2, "gamma", 1), (2, "gamma", 7)}
    wins = dc.windows(spark.createDataFrame([(1, "beta alpha")], "item_id long, text string"))
    got = dc.phrase_places(post, wins).select(F.col("start")).collect()
    assert [r.start for r in got] == [1]


def test_no_python_in_the_plan(spark, tables):
    docs, items = tables
    df = spark.createDataFrame(docs, "doc_id long, text string")
    plan = dc.contamination(df, spark.createDataFrame(items, "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_long_lists_are_left_out(spark):
    """The list of a frequent term is not joined to a few places: these are
    compared word for word."""
    rows = [(i, "the " * 30) for i in range(5)] + [(10, "so rare the end"), (11, "so rare an end"), (12, "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, "Rare the")], "item_id long, text string")
    wins = dc.windows(items)
    post = dc.index(docs, wins.select(F.explode("terms").alias("term")).distinct())
    assert sorted(r.start for r in dc.phrase_places(post, wins).select("start").collect()) == [0, 1, 1]
    got = {r.doc_id: (r.n_hit, r.item_ids) for r in dc.contamination(docs, items).collect()}
    assert got == {i: (2, ["1"]) if i == 10 else (0, []) for i, _ in rows}
