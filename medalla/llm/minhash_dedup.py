"""MinHash near duplicates by a multi-index Hamming join.

A document's set of word shingles becomes a signature of SYMBOLS b-bit
minima, each under a hash order of its own. Two signatures with at most
2 * chunks - 1 differing symbols must, cut into chunks, have one with at most
one difference (pigeonhole). So each chunk is indexed once for every symbol
that may be wrong, with that symbol left out; two signatures within the
radius always meet in some entry. What meets is confirmed on the full shingle
sets. The chunks are as wide as the Jaccard asked for allows (``width_for``).
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalla.llm.common import components, concluded, stage, text_id

CHUNKS, WIDTH = 12, 5
SYMBOLS = CHUNKS * WIDTH
#: greatest signature distance looked for with chunks of WIDTH; every chunk
#: with two errors or more makes 24
RADIUS = 2 * CHUNKS - 1
#: most pairs of exactly the Jaccard asked for that may be missed. Minima
#: under independent orders differ in a binomial number of symbols whatever
#: the size of the sets: 2.3e-6 of the pairs at 0.85 in more than 23 of 60
#: (chunks of 5), 2.1e-7 of those at 0.80 in more than 29 (chunks of 4).
MISSED = 5e-6
#: texts that one task compares with each other, or two blocks of them
BLOCK = 256
_M = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(2).integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_ODD = np.random.default_rng(3).integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@functools.cache
def width_for(percent: int) -> int:
    """The widest chunk whose radius misses at most MISSED of the pairs of
    Jaccard ``percent`` / 100; 2 looks at every pair with an equal symbol."""
    q = 1 - percent / 100
    for width in range(WIDTH, 2, -1):
        if SYMBOLS % width == 0:
            far = range(2 * (SYMBOLS // width), SYMBOLS + 1)
            if sum(math.comb(SYMBOLS, d) * q ** d * (1 - q) ** (SYMBOLS - d) for d in far) <= MISSED:
                return width
    return 2


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles: ``size`` words in
    a row, words being runs of anything but ASCII white space with A-Z
    lowered; all words as one if there are fewer; none without words."""
    words = text.encode().lower().split() if text else ()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(words) < size:  # such a set never equals one of full shingles
        return np.array([xxhash.xxh64_intdigest(h.tobytes(), seed=len(words))], np.uint64)
    n = len(words) - size + 1
    with np.errstate(over="ignore"):
        s = np.full(n, size, np.uint64)
        for i in range(size):
            s = (s ^ h[i:i + n]) * _M
            s ^= s >> np.uint64(32)
    return np.unique(s)


def _mixed(s: np.ndarray, seed, odd) -> np.ndarray:
    """The hashes in the order of one symbol, independent of the others: a
    mere xor would keep neighbours and tie the minima of small sets."""
    h = (s ^ seed) * odd
    h ^= h >> np.uint64(32)
    h *= _M
    h ^= h >> np.uint64(29)
    return h


def signature(s: np.ndarray) -> np.ndarray:
    """16-bit minima: symbol j is the low bits of the smallest shingle hash
    in the order of symbol j."""
    with np.errstate(over="ignore"):
        if len(s) * SYMBOLS <= 1 << 20:
            m = _mixed(s[:, None], _SEEDS[None, :], _ODD[None, :]).min(axis=0)
        else:
            m = np.array([_mixed(s, x, y).min() for x, y in zip(_SEEDS, _ODD)])
        return (m * _M >> np.uint64(48)).astype("<u2")


def entries(sig: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The index entries of (n, SYMBOLS) signatures: a hash of each chunk of
    ``width`` with one symbol left out, (n, SYMBOLS)."""
    chunks = SYMBOLS // width
    c = sig.reshape(len(sig), chunks, width).astype(np.uint64)
    out = np.empty((len(sig), chunks, width), np.uint64)
    with np.errstate(over="ignore"):
        for gone in range(width):
            h = np.arange(chunks, dtype=np.uint64)[None, :] * np.uint64(width) + np.uint64(gone + 1)
            for i in range(width):
                if i != gone:
                    h = (h ^ c[:, :, i]) * _M
                    h ^= h >> np.uint64(31)
            out[:, :, gone] = h
    return out.reshape(len(sig), -1).view(np.int64)


def sign(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, n_shingles, s1, s2, sig, t1, t2`` per row of ``docs(doc_id,
    text)``; ``s1, s2`` stand for the set and ``t1, t2`` for the text (128
    bits each), ``sig`` is null without a shingle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for d, t in zip(b.doc_id, b.text):
                s = shingles(t, size)
                s1, s2 = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8").tolist()
                out.append((d, len(s), s1, s2, signature(s).tobytes() if len(s) else None))
            df = pd.DataFrame(out, columns=["doc_id", "n_shingles", "s1", "s2", "sig"])
            df["doc_id"] = df.doc_id.astype("Int64")
            yield df.assign(t1=b.t1.to_numpy(), t2=b.t2.to_numpy())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *text_id("text")).mapInPandas(
        run, "doc_id long, n_shingles long, s1 long, s2 long, sig binary, t1 long, t2 long")


def index(signed: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(entry, node)``: the index entries of ``signed(node, sig)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 2048):
                p = b.iloc[lo:lo + 2048]
                e = entries(np.frombuffer(b"".join(p.sig), "<u2").reshape(len(p), SYMBOLS), width)
                yield pd.DataFrame({"entry": e.ravel(), "node": np.repeat(p.node.to_numpy(), e.shape[1])})

    return signed.select("node", "sig").mapInPandas(run, "entry long, node long")


def near_links(nodes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` that join all ``nodes(node, sig, rep)`` whose shingle
    sets, those of the rows ``rep(doc_id, t1, t2)`` of ``docs``, have 100 * intersection >= percent * union, directly or over others.

    Entries shared by several nodes tie these to clusters (the smallest node
    of an entry, then components); the nodes of a cluster are the only ones
    compared. A cluster is dealt into blocks of BLOCK nodes and each pair of
    its blocks is a task's group of at most 2 * BLOCK texts, so no group
    grows with the data. In a group the signature distance comes first, then
    the full sets, and only links that join what is not yet joined leave it.
    """
    width = width_for(percent)
    radius = 2 * (SYMBOLS // width) - 1
    entry = index(nodes, width)
    low = entry.groupBy("entry").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    shared = stage(low.where("low <> high"), "entries")
    # entries of two nodes are done; of the others every node is tied to the lowest
    ties = entry.join(shared.select("entry", "low"), "entry").select(F.col("node").alias("a"), F.col("low").alias("b"))
    cc = components(ties.where("a <> b").distinct(), "clusters")
    member = stage(cc.unionByName(cc.select(F.col("root").alias("node"), "root").distinct()), "cluster")
    rep = nodes.join(member.select("node"), "node", "left_semi").select("node", "rep.*")
    keyed = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), *text_id("text"), "text")
    texts = (rep.join(keyed, rep.doc_id.eqNullSafe(keyed.doc_id) & (rep.t1 == keyed.t1) & (rep.t2 == keyed.t2))
             .select("node", "text").dropDuplicates(["node"]))  # a row may be there twice
    blocks = (member.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))
    dealt = (member.join(blocks, "root")
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
             .join(nodes.select("node", "sig"), "node").join(texts, "node"))
    # block i takes part in the pairs (i, j) and (j, i), i <= j
    pairs = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "sig",
        "text")

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("node", kind="stable")
        node = g.node.to_numpy()
        left = (g.block == g.i).to_numpy()
        same = bool(g.i.iloc[0] == g.j.iloc[0])
        sig = np.frombuffer(b"".join(g.sig), "<u2").reshape(len(g), SYMBOLS)
        sets: dict[int, frozenset] = {}
        texts_ = g.text.tolist()
        root = np.arange(len(g))  # components within the group
        out = []

        def full(k):
            if k not in sets:
                sets[k] = frozenset(shingles(texts_[k], size).tolist())
            return sets[k]

        for k in range(len(g)):
            if not same and not left[k]:
                continue
            to = (np.arange(len(g)) > k) if same else ~left
            to &= root != root[k]
            near = np.flatnonzero(to)
            near = near[(sig[near] != sig[k]).sum(axis=1) <= radius]
            for m in near.tolist():
                if root[m] == root[k]:
                    continue
                a, b = full(k), full(m)
                both = len(a & b) if percent * max(len(a), len(b)) <= 100 * min(len(a), len(b)) else 0
                if 100 * both >= percent * (len(a) + len(b) - both):
                    out.append((node[k], node[m]))
                    root[root == root[m]] = root[k]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return pairs.groupBy("root", "i", "j").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_shingles,
    component_id, kept``, and ``root, t1, t2``, which stand for the component
    (null without a shingle) and the text.

    Documents are linked when 100 * intersection >= ``percent`` * union of
    their sets of ``size``-word shingles; ``component_id`` is the smallest
    doc_id reachable, ``kept`` is doc_id = component_id. Equal sets are one
    node from the start, so thousands of copies cost one signature and no
    pairs. Null, empty and blank texts have no set and link with nothing;
    fewer words than ``size`` make one shingle. Rows that repeat a doc_id are
    one node; a row with a null doc_id takes the component of its set and is
    never kept (null component if no row of it has a doc_id). Other columns
    are ignored; an empty table gives an empty result.
    """
    signed = stage(sign(docs, size), "signatures")
    has = F.col("n_shingles") > 0
    # the node of a set is the first half of its 128-bit hash
    classes = stage(signed.where(has).groupBy("s1", "s2", "n_shingles").agg(
        F.min("doc_id").alias("low"), F.first("sig").alias("sig"), F.min(F.struct("doc_id", "t1", "t2")).alias("rep")),
        "set-classes").withColumn("node", F.col("s1"))
    links = concluded(lambda: near_links(classes.select("node", "sig", "rep"), docs, size, percent), "near-links")
    # rows that share a doc_id but not a set meet in that doc_id
    ids = signed.where(has).groupBy("doc_id").agg(F.min("s1").alias("a"), F.max("s1").alias("b")).where("a <> b")
    same = signed.where(has).join(ids, "doc_id").select("a", F.col("s1").alias("b"))
    root = components(links.unionByName(same), "near-cc")
    rooted = stage(classes.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
                   .select("s1", "s2", "n_shingles", "low", "root"), "near-roots")
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(named, "root").select("s1", "s2", "n_shingles", "component_id", "root")
    out = signed.join(named, ["s1", "s2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(has, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "root", "t1", "t2")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near duplicates: of each component the document with
    the smallest doc_id stays (null last, then the smallest text hash).
    Documents without a shingle all stay. Rows equal in doc_id and text are
    one document and come out once."""
    found = concluded(lambda: near_duplicates(docs, size, percent), "near-duplicates")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.xxhash64("doc_id").alias("i"), "t1", "t2")
    by_id = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
    best = found.where("root is not null").groupBy("root").agg(F.min(F.struct(by_id.alias("by"), place.alias("at")))["at"]
                                                               .alias("at")).select("at")
    none = found.where("root is null").select(place.alias("at")).distinct()
    keep = stage(best.unionByName(none).select(F.col("at.i").alias("_i"), F.col("at.t1").alias("_t1"),
                                               F.col("at.t2").alias("_t2")), "kept")
    t1, t2 = text_id("text")
    key = ["_i", "_t1", "_t2"]
    rows = docs.withColumns({"_i": F.xxhash64(F.col("doc_id").cast("long")), "_t1": t1, "_t2": t2})
    return rows.join(keep, key).dropDuplicates(key).select(*docs.columns)  # grouped as joined: one exchange
