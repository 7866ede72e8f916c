"""Repeated passages by a depth-limited radix sort of suffixes.

Only the first WINDOW bytes of a suffix count: suffixes equal so far form the
repeated windows. They are ordered by most-significant-digit passes in which
what is alone drops out:

1. the digit is the window's seed, the SEED bytes with the smallest hash in
   it (by its upper half, leftmost of ties). Equal windows have equal seeds at equal places, and
   neighbouring windows share theirs, so one row stands for a run of windows;
2. the digit is all bytes of a run: equal runs are repeated as a whole;
3. what is left, runs that share a seed with different runs, is ordered by
   the full WINDOW bytes within the seed's group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalla.llm.common import stage

WINDOW = 200
SEED = 32
#: bytes that a task hashes at a time (a longer text is taken whole): the
#: arrays of eight bytes for each of them stay in a core's cache
CHUNK = 1 << 16
#: runs that a task orders at once; a seed with more goes by single windows
GROUP = 4096
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def rolling(a: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of every ``length`` bytes of ``a``, by doubling."""
    if len(a) < length:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        h, have = (a.astype(np.uint64) + np.uint64(1)) * _A, 1
        while have < length:
            step = min(have, length - have)  # the second half may overlap the first
            x = h[:len(h) - step] * _B
            x ^= x >> np.uint64(32)
            x ^= h[step:]
            x *= _A
            h, have = x, have + step
    return h ^ (h >> np.uint64(29))


def leftmost_min(h: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest of each ``width`` values in a row, going by their
    upper 32 bits; of ties the first. The index stands in the lower bits, so
    one minimum of packed values gives both."""
    low = np.uint64(0xFFFFFFFF)
    v, have = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    while have < width:
        step = min(have, width - have)
        v = np.minimum(v[:-step], v[step:])
        have += step
    return (v & low).astype(np.int64)


def runs(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs of windows of some texts: text number, first window, number of
    windows, seed hash and content hash of each. Nothing crosses texts."""
    sizes = np.array([len(t) for t in texts])
    a = np.frombuffer(b"".join(texts), np.uint8)
    seed = min(SEED, window)
    if len(a) < window:
        return (np.empty(0, np.int64),) * 5
    h = rolling(a, seed)
    own = leftmost_min(h, window - seed + 1)
    base = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(len(sizes)), sizes)[:len(own)]
    inside = np.arange(len(own)) + window <= base[text + 1]
    cut = np.flatnonzero((np.diff(own) != 0) | (np.diff(text) != 0) | (np.diff(inside.astype(np.int8)) != 0)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(own)]])
    ok = inside[first]
    first, last = first[ok], last[ok]
    buf = a.tobytes()
    content = np.fromiter((xxhash.xxh3_64_intdigest(buf[f:e + window - 1]) for f, e in zip(first.tolist(), last.tolist())),
                          np.uint64, len(first))
    t = text[first]
    return t, first - base[t], last - first, h[own[first]].view(np.int64), content.view(np.int64)


def _chunked(batches: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Keys and texts of about CHUNK bytes at a time; a text that a partition
    holds more than ``most`` times is passed on that often only."""
    met: dict[int, int] = {}
    keys, texts, size = [], [], 0
    for b in batches:
        for key, text in zip(b.key.tolist(), b.text):
            n = met.get(key, 0)
            if n == most:
                continue
            met[key] = n + 1
            t = text.encode()
            keys.append(key), texts.append(t)
            size += len(t)
            if size >= CHUNK:
                yield np.array(keys), texts
                keys, texts, size = [], [], 0
    if texts:
        yield np.array(keys), texts


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.where("text is not null").select(F.xxhash64("text").alias("key"), "text")


def all_runs(docs: DataFrame, window: int) -> DataFrame:
    """``(key, place, seed, content)`` of every run: ``place`` is its first
    window and number of windows in one long. A text that a partition holds
    more than twice counts as two: that is enough to be repeated, and a text
    with a third of all rows makes two rows a run and partition at most."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys, texts in _chunked(batches, 2):
            t, first, n, seed, content = runs(texts, window)
            if len(t):
                yield pd.DataFrame({"key": keys[t], "place": first << 16 | n, "seed": seed, "content": content})

    return _keyed(docs).mapInPandas(make, "key long, place long, seed long, content long")


def repeated_windows(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """``(key, first, n)``: runs of windows of the text ``key`` that start
    anywhere else too, in ``docs(text)``."""
    # pass 1: seeds that occur once drop out
    seeds = all_runs(docs, window).groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("seed")
    left = stage(all_runs(docs, window).join(seeds, "seed"), "seed-runs")
    # pass 2: equal runs; of each distinct one a representative goes on
    run = stage(left.groupBy("seed", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("rep")), "distinct-runs")
    whole = left.join(run.where("n > 1").select("seed", "content"), ["seed", "content"], "left_semi").select(
        "key", F.shiftright("place", 16).alias("first"), F.col("place").bitwiseAND(0xFFFF).alias("n"))
    kinds = run.groupBy("seed").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    mixed = kinds.where("kinds > 1 and least = 1")
    # pass 3: the bytes of the distinct runs of a mixed seed meet
    need = run.join(mixed.select("seed", "kinds"), "seed").select(
        F.col("rep.key").alias("key"), F.struct(F.col("rep.place").alias("place"), "seed", "kinds", "n").alias("run"))
    need = need.groupBy("key").agg(F.collect_list("run").alias("runs"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        done: set[int] = set()
        for b in batches:
            out = []
            for key, text, found in zip(b.key.tolist(), b.text, b.runs):
                if key in done:
                    continue
                done.add(key)
                t = text.encode()
                for r in found:
                    first, n = r["place"] >> 16, r["place"] & 0xFFFF
                    out.append((r["seed"], r["kinds"], key, first, n, r["n"] == 1, t[first:first + n + window - 1]))
            if out:
                yield pd.DataFrame(out, columns=["seed", "kinds", "key", "first", "n", "single", "bytes"])

    texts = _once(docs).join(need, "key")
    bytes_ = stage(texts.mapInPandas(cut, "seed long, kinds long, key long, first long, n long, single boolean, "
                                          "bytes binary"), "run-bytes")
    small = bytes_.where(F.col("kinds") <= group).repartition("seed").sortWithinPartitions("seed")

    def hashed(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Window hashes of all runs of ``b``, the row and the place of each."""
        buf = np.frombuffer(b"".join(b.bytes), np.uint8)
        n = b.n.to_numpy()
        row = np.repeat(np.arange(len(b)), n)
        off = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        base = np.concatenate([[0], np.cumsum(n + window - 1)[:-1]])
        return rolling(buf, window)[base[row] + off], row, off

    def order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def groups():
            held = None
            for b in batches:
                held = b if held is None else pd.concat([held, b], ignore_index=True)
                last = held.seed.to_numpy() == held.seed.iloc[-1]
                if not last.all():
                    yield held[~last]
                    held = held[last]
            if held is not None and len(held):
                yield held

        for b in groups():
            b = b.drop_duplicates(["seed", "key", "first"])  # a text may have come from several partitions
            h, row, off = hashed(b)
            with np.errstate(over="ignore"):
                h = (h ^ b.seed.to_numpy().view(np.uint64)[row]) * _A
            by = np.argsort(h)
            s = h[by]
            same = s[1:] == s[:-1]
            twice = np.empty(len(h), bool)
            twice[by] = np.concatenate([same, [False]]) | np.concatenate([[False], same])
            yield _spans(b, row, off, twice & b.single.to_numpy()[row])

    def single(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for big in batches:
            for lo in range(0, len(big), 1024):
                b = big.iloc[lo:lo + 1024]
                h, row, off = hashed(b)
                yield pd.DataFrame({"seed": b.seed.to_numpy()[row], "h": h.view(np.int64),
                                    "key": b.key.to_numpy()[row], "first": b["first"].to_numpy()[row] + off,
                                    "single": b.single.to_numpy()[row]})

    spans = "key long, first long, n long"
    found = small.mapInPandas(order, spans)
    # seeds with very many distinct runs: one more pass, window by window
    wide = (bytes_.where(F.col("kinds") > group).mapInPandas(
        single, "seed long, h long, key long, first long, single boolean").distinct())
    again = wide.groupBy("seed", "h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("seed", "h")
    alone = wide.where("single").join(again, ["seed", "h"], "left_semi").select("key", "first", F.lit(1).cast("long").alias("n"))
    return whole.unionByName(found).unionByName(alone)


def _spans(b: pd.DataFrame, row: np.ndarray, off: np.ndarray, hit: np.ndarray) -> pd.DataFrame:
    """Runs of hits in a row of ``b``, as text key, first window and number."""
    row, at = row[hit], b["first"].to_numpy()[row[hit]] + off[hit]
    new = np.concatenate([[True], (np.diff(row) != 0) | (np.diff(at) != 1)]) if len(row) else np.empty(0, bool)
    start = np.flatnonzero(new)
    return pd.DataFrame({"key": b.key.to_numpy()[row[start]], "first": at[start],
                         "n": np.diff(np.concatenate([start, [len(row)]]))})


def _once(docs: DataFrame) -> DataFrame:
    """``(key, text)``: each text once per partition."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: set[int] = set()
        for b in batches:
            fresh = ~b.key.duplicated() & ~b.key.isin(met)
            met.update(b.key[fresh].tolist())
            yield b[fresh]

    return _keyed(docs).mapInPandas(make, "key long, text string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, group: int = GROUP, kept: bool = True) -> DataFrame:
    """``docs`` with ``n_bytes, n_removed, n_spans, kept_sha256`` and, with
    ``kept``, the remaining bytes in ``kept``.

    Every byte of a text's UTF-8 form that some ``window``-byte string covers
    which also starts anywhere else - in another row, or elsewhere in the
    same - is removed; all is judged on the input, nothing crosses rows. So
    texts that occur twice go whole if they have ``window`` bytes, shorter
    texts always stay. Null text counts as empty. Rows equal in text get the
    same result each, whatever their ids; other columns are kept, those of
    the names above replaced; an empty table gives an empty result.
    """
    spans = (repeated_windows(docs, window, group).groupBy("key")
             .agg(F.collect_list(F.struct("first", "n")).alias("spans")))
    spans = stage(spans, "spans")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, text, found in zip(b.key.tolist(), b.text, b.spans):
                t = text.encode()
                edge = np.zeros(len(t) + 1, np.int32)
                first = np.array([r["first"] for r in found])
                end = first + np.array([r["n"] for r in found]) + window - 1
                np.add.at(edge, first, 1)
                np.add.at(edge, end, -1)
                gone = np.cumsum(edge[:-1]) > 0
                rest = np.frombuffer(t, np.uint8)[~gone].tobytes()
                n_spans = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                out.append((key, int(gone.sum()), n_spans, hashlib.sha256(rest).hexdigest(), *([rest] if kept else [])))
            yield pd.DataFrame(out, columns=names)

    names = ["_key", "n_removed", "n_spans", "kept_sha256", *(["kept"] if kept else [])]
    done = (_once(docs).join(spans, "key").mapInPandas(
        digest, "_key long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * kept))
    # a text may come from several partitions: all its rows are equal
    done = stage(done, "removed").dropDuplicates(["_key"])
    # the row travels as one column, so that no name of its own clashes
    rows = docs.drop("n_bytes", *names[1:]).select(F.struct("*").alias("row"), F.xxhash64("text").alias("_key"),
                                               F.coalesce("text", F.lit("")).cast("binary").alias("all"))
    rows = rows.join(done, "_key", "left")
    zero = F.lit(0).cast("long")
    return rows.select(
        "row.*", F.octet_length("all").cast("long").alias("n_bytes"), F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", F.sha2("all", 256)).alias("kept_sha256"),
        *([F.coalesce("kept", "all").alias("kept")] if kept else []))
