"""Benchmark decontamination with a distributed positional inverted index.

The postings (term, text, position) of every corpus word that a benchmark
item uses are stored; the windows of the items are looked up in them by
intersecting offset-adjusted lists, the rarest terms of a window first. Only
DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from medalla.llm.common import ascii_lower, concluded, stage

WINDOW = 10
#: lists intersected before a place is compared word for word
LISTS = 3
#: a list is left out if it is so many times as long as the places that a
#: window has left: these are sooner compared word for word
LONGER = 8
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column | str) -> Column:
    """Words of a text, A-Z lowered: runs of a-z, 0-9 and beyond ASCII."""
    # the plain lower() is faster and the same on a text of ASCII only
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.coalesce(F.array_remove(F.split(low, _BETWEEN), ""), F.array().cast("array<string>"))


def text_key(text: Column | str) -> Column:
    return F.xxhash64(text)


def windows(items: DataFrame, length: int = WINDOW) -> DataFrame:
    """Distinct windows of ``items(item_id, text)``: ``win`` (hash of the
    terms), ``terms`` and ``items``, the sorted ids that have it. An item with
    fewer words than ``length``, but not none, is one window; null and
    wordless items have none. A null item_id counts as the empty string."""
    w = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words("text").alias("w"))
    many = F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice("w", i, length))
    w = w.where(F.size("w") > 0).select("item", F.explode(
        F.when(F.size("w") >= length, many).otherwise(F.array("w"))).alias("terms"))
    return w.groupBy("terms").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        F.xxhash64("terms").alias("win"), "terms", "items")


def index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings ``(term, key, pos)`` of the ``terms(term)`` in whole texts,
    ``key`` standing for a text and positions counted from 0. Written as a
    table; a narrow pass unless the terms outgrow Spark's broadcast limit."""
    w = docs.where("text is not null").select(text_key("text").alias("key"), F.posexplode(words("text")).alias("pos", "term"))
    return stage(w.join(terms, "term").select("term", "key", "pos"), "postings")


def phrase_places(postings: DataFrame, wins: DataFrame, lists: int = LISTS) -> DataFrame:
    """Places ``(key, start, len, win, items)`` that hold up to ``lists`` of
    the rarest terms of a window at the window's offsets.

    Starts from the list of the rarest term of each window, shifted by its
    offset, and keeps what the next rarest list, shifted likewise, holds too,
    unless that list is ``LONGER`` times as long as the places left: what moves
    grows with the places, not with the lists of frequent terms. Places are
    candidates, those of every occurrence among them.
    Equal texts have one key, so copies collapse before anything is joined.
    """
    frequency = stage(postings.groupBy("term").agg(F.count(F.lit(1)).alias("freq")), "term-counts")
    at = wins.select("win", F.posexplode("terms").alias("off", "term")).join(frequency, "term")
    # a window with a term that the corpus lacks cannot occur
    ranked = (at.groupBy("win").agg(F.sort_array(F.collect_list(F.struct("freq", "off", "term"))).alias("by"))
              .join(wins.select("win", F.size("terms").alias("len"), "items"), "win").where(F.size("by") == F.col("len")))
    ranked = stage(ranked, "windows")
    places = None
    for k in range(lists):
        step = ranked.where(F.size("by") > k).select("win", F.col("by")[k]["off"].alias("off"),
                                                     F.col("by")[k]["term"].alias("term"), F.col("by")[k]["freq"].alias("freq"))
        if places is not None:  # one row a window
            left = places.groupBy("win").agg(F.count(F.lit(1)).alias("left"))
            step = stage(step.join(left, "win").where(F.col("freq") <= LONGER * F.col("left")), "window-steps")
        found = (postings.join(step.select("win", "off", "term"), "term")
                 .select("key", "win", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0"))
        if places is None:
            places = stage(found.distinct(), "places")
            continue
        done = places.join(step.select("win"), "win", "left_anti")  # windows with no further list
        places = stage(places.join(found, ["key", "win", "start"], "left_semi").unionByName(done), "places")
    return places.join(ranked.select("win", "len", "items"), "win").select("key", "start", "len", "win", "items")


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words, n_hit, n_items, item_ids, contaminated``: a
    word is hit inside any exact occurrence of a window of an item, and
    ``item_ids`` are the items (sorted strings) with such windows.

    Places that come out of the index are confirmed word for word (by the
    hash of the window's words) on the text of each row; the only shuffle of
    texts is that join. Null, empty and wordless texts have no words and no
    hits; repeated rows and copies get the same result each; without items
    nothing is hit. All other columns are kept, those of these names
    replaced.
    """
    added = ["n_words", "n_hit", "n_items", "item_ids", "contaminated"]
    docs = docs.drop(*added)

    def found() -> DataFrame:
        wins = stage(windows(items, length), "item-windows")
        terms = stage(wins.select(F.explode("terms").alias("term")).distinct(), "item-terms")
        places = phrase_places(index(docs, terms), wins)
        return places.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "len", "win", "items"))).alias("at"))

    by_text = concluded(found, "places-by-text")
    # the row travels as one column, so that no name of its own clashes
    rows = docs.select(F.struct("*").alias("row"), text_key("text").alias("key")).join(by_text, "key", "left")
    rows = rows.withColumn("w", words("row.text"))
    rows = rows.withColumns({"n_words": F.size("w").cast("long"), "m": F.filter(
        F.coalesce("at", F.array()), lambda p: F.xxhash64(F.slice("w", p["start"] + 1, p["len"])) == p["win"])})
    zero = F.lit(0).cast("long")
    hit = F.aggregate("m", F.struct(zero.alias("n"), zero.alias("to")), lambda a, p: F.struct(
        (a["n"] + F.greatest(zero, p["start"] + p["len"] - F.greatest(p["start"].cast("long"), a["to"]))).alias("n"),
        F.greatest(a["to"], (p["start"] + p["len"]).cast("long")).alias("to")))["n"]
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("m", lambda p: p["items"]))))
    rows = rows.withColumns({"n_hit": hit, "item_ids": ids})
    rows = rows.withColumns({"n_items": F.size("item_ids").cast("long"), "contaminated": F.col("n_hit") > 0})
    return rows.select("row.*", *added)


def proximity_places(postings: DataFrame, sets: DataFrame, span: int) -> DataFrame:
    """Places ``(key, id, start)`` where all terms of a set of
    ``sets(id, term)`` stand within ``span`` words, in any order, the first
    of them at ``start``. The texts come from the set's rarest list; only they
    are searched. Sets with a term that the postings lack match nowhere."""
    sets = sets.distinct()
    freq = postings.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    size = sets.join(freq, "term", "left").groupBy("id").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct(F.coalesce("freq", F.lit(0)), "term"))["term"].alias("term"))
    texts = postings.join(size.select("id", "term"), "term").select("id", "key").distinct()
    rows = postings.join(sets, "term").join(texts, ["id", "key"]).join(size.select("id", "size"), "id")
    near = W.partitionBy("id", "key").orderBy("pos").rangeBetween(0, span - 1)
    return (rows.withColumn("n", F.size(F.collect_set("term").over(near))).where("n = size")
            .select("key", "id", F.col("pos").alias("start")).distinct())
