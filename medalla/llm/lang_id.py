"""Language identification by interpolated Kneser-Ney character models.

One model per language, counted over every labelled text, no n-gram left out;
each model is a set of sorted 64-bit hash arrays (n-gram -> discounted
probability, context -> back-off weight), written by Spark in ranges of hashes
below the shared checkpoint folder. Tasks read the ranges they need from there
and keep a bounded number of bytes of them. A text gets the language whose
model has the lowest cross-entropy per character; it is rejected if even that
is above what the labelled texts of that language show at its length.
"""

from __future__ import annotations

import functools
from collections import OrderedDict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medalla.llm.common import scratch_root, stage

ORDER = 5
#: entries of the models in one range of hashes, about: what a task reads at once
PER_RANGE = 2_000_000
#: bytes of the models that a Python worker holds; ranges beyond are read anew
HELD_BYTES = 96 << 20
#: characters handled at a time
CHUNK = 1 << 18
#: n-grams already looked up that a Python worker holds, at most
REMEMBERED = 500_000
#: letters from which on the subject of a text, not their number, is what
#: moves its cross-entropy
TOPIC = 2000
SPACE = 0x20
_B = np.uint64(0x9E3779B97F4A7C15)
#: marks the hash of an n-gram as that of a context
_CONTEXT = 0x5851F42D4C957F2D
UNKNOWN = "und"


class Model(NamedTuple):
    """What finds the models: languages in order, the folder of the hash
    arrays, the bits of a hash that name its range at each order from 1 up,
    and the kinds of characters."""

    langs: list[str]
    path: str
    bits: list[int]
    alphabet: int


@functools.cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def normalise(text: str) -> np.ndarray:
    """Code points: lower case, each run of anything but letters one space;
    ORDER - 1 spaces before, one after. Empty if there is no letter."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    letter = _letters()[a]
    if not letter.any():
        return np.empty(0, dtype=np.uint32)
    a = np.where(letter, a, SPACE).astype(np.uint32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # a space counts once, after a letter
    a = a[keep]
    tail = [] if a[-1] == SPACE else [SPACE]
    return np.concatenate([np.full(ORDER - 1, SPACE, np.uint32), a, np.array(tail, np.uint32)])


def hashes(chars: np.ndarray, order: int) -> np.ndarray:
    """Hash of each of ``chars[..., :order]``, the characters being the last
    axis of a (n, order) view."""
    with np.errstate(over="ignore"):
        h = np.full(chars.shape[0], order, dtype=np.uint64)
        for i in range(order):
            h = (h ^ chars[:, i].astype(np.uint64)) * _B
            h ^= h >> np.uint64(29)
    return h


def chunks(texts: list[str | None], size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Predicted places of the texts, about ``size`` at a time: an (n, ORDER)
    view of characters, the start of each text's part, and the texts' numbers.
    A long text comes in several parts."""
    parts: list[np.ndarray] = []
    owner: list[int] = []
    held = 0
    for i, t in enumerate(texts):
        a = normalise(t) if t else np.empty(0, np.uint32)
        for lo in range(0, max(0, len(a) - ORDER + 1), size):
            p = np.lib.stride_tricks.sliding_window_view(a[lo:lo + size + ORDER - 1], ORDER)
            parts.append(p)
            owner.append(i)
            held += len(p)
            if held >= size:
                yield _joined(parts, owner)
                parts, owner, held = [], [], 0
    if parts:
        yield _joined(parts, owner)


def _joined(parts, owner):
    return np.concatenate(parts), np.cumsum([0, *map(len, parts[:-1])]), np.array(owner)


def grouped(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, a place of each, and each place's number among them."""
    order = np.argsort(h)
    s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    number = np.empty(len(h), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return s[new], order[new], number


def count_ngrams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``(lang, gram, n)`` over all texts of ``docs(text, lang)``. Each task
    sums up what it has read, then Spark sums over tasks."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple] = {}

        def flush(lang):
            h, grams, n = held.pop(lang)
            text = np.ascontiguousarray(grams).view(f"<U{order}").ravel()
            return pd.DataFrame({"lang": lang, "gram": text.astype(object), "n": n})

        for b in batches:
            for lang, part in b.groupby("lang"):
                for chars, _, _ in chunks(part.text.tolist()):
                    u, at, number = grouped(hashes(chars, order))
                    grams, n = chars[at], np.bincount(number)
                    if lang in held:
                        h0, g0, n0 = held[lang]
                        both = np.concatenate([h0, u])
                        grams = np.concatenate([g0, grams])
                        u, at, number = grouped(both)
                        grams, n = grams[at], np.bincount(number, weights=np.concatenate([n0, n])).astype(np.int64)
                    held[lang] = u, grams, n
                    if len(u) > 1_000_000:
                        yield flush(lang)
        for lang in list(held):
            yield flush(lang)

    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    return (rows.mapInPandas(count, "lang string, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, order: int = ORDER, per_range: int = PER_RANGE) -> Model:
    """Fits a model for each non-null ``lang`` of ``docs(text, lang)``.

    The highest order counts occurrences, each lower one the distinct
    characters seen before (continuation counts), all in Spark. Every n-gram
    and every context stays in the model, which grows with the corpus: of
    each order a folder of ranges of hashes, about ``per_range`` entries each,
    sorted by language and hash. Only the languages and the sizes come to the
    driver. No labelled text with a letter: a model without languages.
    """
    spark = docs.sparkSession
    counts = stage(count_ngrams(docs, order), "ngrams")
    path, bits, alphabet = scratch_root(spark, "lang-model"), [], 1
    langs = sorted(r.lang for r in counts.select("lang").distinct().collect())
    for k in range(order, 0, -1):
        context = F.substring("gram", 1, k - 1)
        ctx = counts.groupBy("lang", context.alias("ctx")).agg(F.sum("n").alias("total"),
                                                              F.count(F.lit(1)).alias("kinds"))
        one, two = (F.sum((F.col("n") == i).cast("long")) for i in (1, 2))
        discount = counts.groupBy("lang").agg(F.when(one > 0, F.least(F.lit(0.95), F.greatest(
            F.lit(0.05), one / (one + 2 * two)))).otherwise(F.lit(0.5)).alias("d"))  # one row a language
        ctx = stage(ctx.join(F.broadcast(discount), "lang"), "contexts")
        alpha = counts.withColumn("ctx", context).join(ctx, ["lang", "ctx"]).select(
            "lang", F.col("gram").alias("text"), (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("v"))
        gamma = ctx.select("lang", F.col("ctx").alias("text"), (F.col("d") * F.col("kinds") / F.col("total")).alias("v"))
        grams = counts.count()
        bits.insert(0, max(0, (grams + ctx.count() - 1).bit_length() - per_range.bit_length() + 1))
        _write(_hashed(alpha, k).unionByName(_hashed(gamma, k - 1, _CONTEXT)), langs, bits[0], f"{path}/{k}")
        if k == 1:
            alphabet = max(2, counts.select("gram").distinct().count())
        else:  # continuation counts: distinct characters before
            counts = stage(counts.groupBy("lang", F.substring("gram", 2, k - 1).alias("gram")).agg(
                F.count(F.lit(1)).alias("n")), "ngrams")
    return Model(langs, path, bits, alphabet)


def _hashed(rows: DataFrame, k: int, mark: int = 0) -> DataFrame:
    """``(lang, h, v)`` of ``rows(lang, text, v)``, texts of ``k`` characters;
    hashes xored with ``mark``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            points = np.frombuffer("".join(b.text).encode("utf-32-le"), np.uint32) if k else np.empty(0, np.uint32)
            h = hashes(points.reshape(len(b), k), k) ^ np.uint64(mark)
            yield pd.DataFrame({"lang": b.lang, "h": h.view(np.int64), "v": b.v.astype("float32")})

    return rows.mapInPandas(run, "lang string, h long, v float")


def _write(rows: DataFrame, langs: list[str], bits: int, path: str) -> None:
    """Ranges of ``rows(lang, h, v)``, hashed evenly, one folder each, sorted
    by language (its number in ``langs``) and unsigned hash."""
    number = F.array_position(F.array(*map(F.lit, langs)), F.col("lang")) - 1 if langs else F.lit(0)
    part = F.shiftrightunsigned("h", 64 - bits).cast("int") if bits else F.lit(0)
    rows = rows.select(part.alias("range"), number.cast("int").alias("lang"), "h", "v")
    (rows.repartition(1 << bits, "range").sortWithinPartitions("range", "lang", F.col("h").bitwiseXOR(F.lit(-(1 << 63))))
     .write.partitionBy("range").parquet(path))


class Ranges:
    """Reads ranges of a model's hash arrays, the last ones used kept up to
    ``HELD_BYTES``."""

    def __init__(self, model: Model):
        self.model, self.held, self.bytes = model, OrderedDict(), 0
        if "://" in model.path:
            self.fs, self.root = pyarrow.fs.FileSystem.from_uri(model.path)
        else:
            self.fs, self.root = pyarrow.fs.LocalFileSystem(), model.path.removeprefix("file:")

    def arrays(self, k: int, part: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Sorted hashes and values of each language."""
        if (k, part) in self.held:
            self.held.move_to_end((k, part))
            return self.held[k, part]
        folder = pyarrow.fs.FileSelector(f"{self.root}/{k}/range={part}", allow_not_found=True)
        tables = [pq.read_table(f.path, filesystem=self.fs, columns=["lang", "h", "v"], partitioning=None)
                  for f in sorted(self.fs.get_file_info(folder), key=lambda f: f.path) if f.path.endswith(".parquet")]
        lang, h, v = (np.concatenate([t[c].to_numpy() for t in tables] or [np.empty(0, d)])
                      for c, d in (("lang", np.int32), ("h", np.int64), ("v", np.float32)))
        h, out = h.view(np.uint64), []
        if len(tables) > 1:
            o = np.lexsort((h, lang))
            lang, h, v = lang[o], h[o], v[o]
        for i in range(len(self.model.langs)):
            lo, hi = np.searchsorted(lang, [i, i + 1])
            out.append((h[lo:hi], v[lo:hi]))
        self.held[k, part] = out
        self.bytes += h.nbytes + v.nbytes
        while self.bytes > HELD_BYTES and len(self.held) > 1:
            _, old = self.held.popitem(last=False)
            self.bytes -= sum(a.nbytes + b.nbytes for a, b in old)
        return out

    def find(self, k: int, wanted: np.ndarray, default: float) -> np.ndarray:
        """The (n, languages) values of hashes at order ``k``."""
        out = np.full((len(wanted), len(self.model.langs)), default)
        u, number = np.unique(wanted, return_inverse=True)
        bits = self.model.bits[k - 1]
        part = (u >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(u), np.int64)
        found = np.full((len(u), len(self.model.langs)), default)
        ends = np.searchsorted(part, np.arange((1 << bits) + 1))
        for r in np.flatnonzero(np.diff(ends)):
            mine = slice(ends[r], ends[r + 1])
            for j, (keys, values) in enumerate(self.arrays(k, int(r))):
                found[mine, j] = _find(keys, values, u[mine], default)
        np.take(found, number, axis=0, out=out)
        return out


def log_probs(model: Model, chars: np.ndarray, ranges: Ranges | None = None) -> np.ndarray:
    """log P(last character | those before) of (n, ORDER) n-grams under each
    language: interpolated from order 1 up. A context that a language never
    had has back-off 1: the next lower order holds."""
    ranges = ranges or Ranges(model)
    order = chars.shape[1]
    p = np.full((chars.shape[0], len(model.langs)), 1.0 / (model.alphabet + 1))
    for k in range(1, order + 1):
        p *= ranges.find(k, hashes(chars[:, order - k:], k - 1) ^ np.uint64(_CONTEXT), 1.0)
        p += ranges.find(k, hashes(chars[:, order - k:], k), 0.0)
    return np.log(np.maximum(p, 1e-12))


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], default)


def cross_entropies(model: Model, texts: list[str | None], memo: dict, ranges: Ranges) -> tuple[np.ndarray, np.ndarray]:
    """Nats per character of each text under each language, and the
    characters. ``memo`` keeps n-grams already looked up, ``REMEMBERED`` at most."""
    total = np.zeros((len(texts), len(model.langs)))
    n = np.zeros(len(texts), dtype=np.int64)
    for chars, starts, owner in chunks(texts):
        u, at, number = grouped(hashes(chars, ORDER))
        keys, vals = memo.get("keys", np.empty(0, np.uint64)), memo.get("vals", np.empty((0, len(model.langs))))
        pos = np.minimum(np.searchsorted(keys, u), max(0, len(keys) - 1))
        known = keys[pos] == u if len(keys) else np.zeros(len(u), bool)
        if not known.all():
            fresh = u[~known]
            if len(keys) + len(fresh) > REMEMBERED:
                memo.clear()
                keys, vals, fresh, known = keys[:0], vals[:0], u, np.zeros(len(u), bool)
            into = np.searchsorted(keys, fresh)  # both sorted
            vals = np.insert(vals, into, log_probs(model, chars[at[~known]], ranges), axis=0)
            keys = np.insert(keys, into, fresh)
            memo["keys"], memo["vals"] = keys, vals
            pos = np.searchsorted(keys, u)
        place = vals[pos][number]
        np.add.at(total, owner, np.add.reduceat(place, starts, axis=0))
        np.add.at(n, owner, np.diff([*starts, len(chars)]))
    return -total / np.maximum(n, 1)[:, None], n


def predict(docs: DataFrame, model: Model, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with ``lang_pred, score, nats, n_letters``.

    ``score`` is the share of the best language in exp(-nats per character);
    ``nats`` its cross-entropy per character; ``n_letters`` the characters it
    was taken over (letters and the spaces between words). Null texts, texts
    without a letter and a model without languages give ``und`` with score 0
    and null nats; ties go to the first language in order. A narrow pass over
    whole texts; other columns are kept, columns of these names replaced.
    """
    out = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
                        T.StructField("nats", T.DoubleType()), T.StructField("n", T.LongType())])

    @F.pandas_udf(out)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m, memo, ranges = model, {}, Ranges(model)
        names = np.array([*m.langs, UNKNOWN], dtype=object)
        for texts in batches:
            if not m.langs:
                yield pd.DataFrame({"lang": [UNKNOWN] * len(texts), "score": 0.0, "nats": None, "n": 0})
                continue
            ce, n = cross_entropies(m, texts.tolist(), memo, ranges)
            best = ce.argmin(axis=1)
            low = ce[np.arange(len(ce)), best]
            share = 1.0 / np.exp(low[:, None] - ce).sum(axis=1)
            none = n == 0
            yield pd.DataFrame({"lang": names[np.where(none, len(m.langs), best)], "score": np.where(none, 0.0, share),
                                "nats": pd.Series(np.where(none, np.nan, low)).astype(object).where(~none, None),
                                "n": n})

    added = {lang: "lang", score: "score", "nats": "nats", "n_letters": "n"}
    # the row travels as one column, so that no name of its own clashes
    return (docs.drop(*added).select(F.struct("*").alias("row"), run("text").alias("found"))
            .select("row.*", *(F.col(f"found.{v}").alias(k) for k, v in added.items())))


def _spread(n) -> Column:
    """How far the cross-entropy of a text of ``n`` letters strays, up to a
    factor: by chance of its letters, and by its subject, as if no text were
    longer than ``TOPIC`` letters."""
    return F.sqrt(1 / F.col(n) + F.lit(1 / TOPIC))


def calibrate(scored: DataFrame, rate: float = 0.0005) -> DataFrame:
    """``(lang, middle, strays)``, one row a language: the median
    cross-entropy and the quantile at 1 - ``rate`` of how far texts lie above
    it, in units of ``_spread``; every row counts, whatever its length.

    From ``scored(lang, lang_pred, nats, n_letters)``, rows the models have
    not seen, whose label is known and was found.
    """
    ok = scored.where("lang = lang_pred and n_letters > 0").select("lang", "nats", "n_letters")
    middle = ok.groupBy("lang").agg(F.percentile_approx("nats", 0.5, 10000).alias("middle"))
    over = (F.col("nats") - F.col("middle")) / _spread("n_letters")
    return (ok.join(F.broadcast(middle), "lang")  # one row a language
            .groupBy("lang").agg(F.first("middle").alias("middle"), F.greatest(F.lit(0.0), F.percentile_approx(
                over, 1 - rate, 10000)).alias("strays")))


def with_rejection(scored: DataFrame, limits: DataFrame, margin: float = 1.0, least: float = 0.8) -> DataFrame:
    """``scored`` with boolean ``rejected``: ``und``, or nats above the limit
    of the language at the text's length. The limit lies ``strays`` spreads
    above the median and then as much again times ``margin``, ``least`` nats
    more at the least. One smooth rule at every length and number of rows; of
    a language that has no calibrating row at all every text is kept."""
    out = F.col("strays") * _spread("row.n_letters")
    j = scored.drop("rejected").select(F.struct("*").alias("row"))  # one column: no name of its own clashes
    j = j.join(F.broadcast(limits), F.col("row.lang_pred") == F.col("lang"), "left")  # one row a language
    return j.select("row.*", ((F.col("row.lang_pred") == UNKNOWN) | F.coalesce(
        F.col("row.nats") > F.col("middle") + out + F.greatest(F.lit(least), margin * out), F.lit(False))).alias("rejected"))


def fold(doc_id="doc_id"):
    """crc32 of the id as text, modulo 4."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text, lang, ...)`` with the columns of ``predict``,
    ``held_out`` and ``rejected``. Of the labelled rows, folds 0 and 1 train
    the models, fold 3 sets the limits of rejection and fold 2 is held out. A
    null doc_id is in no fold: it is predicted but not learnt from."""
    docs = docs.withColumn("held_out", F.coalesce(fold() == 2, F.lit(False)))
    known = F.col("lang").isNotNull()
    scored = stage(predict(docs, train(docs.where(fold().isin(0, 1) & known))), "lang-scores")
    limits = stage(calibrate(scored.where((fold() == 3) & known)), "lang-limits")
    return with_rejection(scored, limits)
