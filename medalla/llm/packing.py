"""Sum-of-squares packing of tokenised documents into fixed-length sequences."""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from medalla.llm.common import stage

#: a text with so many characters of white space beyond one between words may
#: hold a run that tiktoken's regular expression cannot match (its stack ends
#: at some hundred thousand): ``tokenizers`` encodes it
LONG_BLANKS = 16_384
#: pieces packed by one task; each task leaves a few sequences unfilled
PIECES_PER_GROUP = 65_536


class Encoder:
    """``fast`` and ``slow`` give the same ids; ``slow`` takes any text."""

    def __init__(self, fast, slow):
        self.fast, self.slow = fast, slow

    def encode_ordinary(self, text: str) -> list[int]:
        if len(text) > LONG_BLANKS:
            words = text.split()
            if len(text) - sum(map(len, words)) - len(words) > LONG_BLANKS:
                return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


@functools.cache
def encoder(path: str) -> Encoder:
    """The byte-level BPE of a ``tokenizers`` JSON file, run by tiktoken on
    the same vocabulary: the ids are equal (``tests/llm`` compare them) at
    about seven times the speed. Both encoders are compared on a probe text
    when a worker loads the file. Texts with very long runs of white space go
    to ``tokenizers`` itself."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()
             if all(c in byte_of for c in token) and not (token.startswith("<|") and token.endswith("|>"))}
    fast = tiktoken.Encoding("from-json", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow = Tokenizer.from_file(path)
    slow.encode_special_tokens = True
    probe = "A probe's text:  ß 12,345\n\n\té漢字 <|endoftext|> x" * 2
    if fast.encode_ordinary(probe) != slow.encode(probe, add_special_tokens=False).ids:
        raise ValueError(f"{path} is not the byte-level BPE this encoder expects")
    return Encoder(fast, slow)


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                    with_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and,
    with ``with_ids``, ``ids`` (little-endian unsigned 32-bit numbers, so that
    they move and are stored as one value; ``id_array`` reads them).

    A document is its token ids and ``end_id``; one longer than ``capacity``
    is cut into pieces of exactly ``capacity``, the first being what is left
    over. Null text counts as empty (one id). Texts are encoded whole, a
    bounded number at a time.
    """
    rows = docs.select("doc_id", "text")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer_path)
        for big in batches:
            for lo in range(0, len(big), 512):
                b = big.iloc[lo:lo + 512]
                out = []
                for d, text in zip(b.doc_id, b.text):
                    ids = np.array([*(enc.encode_ordinary(text) if text else ()), end_id], dtype="<u4")
                    first = (len(ids) - 1) % capacity + 1
                    bounds = [0, *range(first, len(ids) + 1, capacity)]
                    for i, (s, e) in enumerate(zip(bounds, bounds[1:])):
                        p = ids[s:e]
                        out.append((d, i, s, e - s, zlib.crc32(p.tobytes()), *([p.tobytes()] if with_ids else [])))
                df = pd.DataFrame(out, columns=names)
                df["doc_id"] = df.doc_id.astype("Int64")
                yield df

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return rows.mapInPandas(cut, schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places each length in turn where the sum over gaps g of (open bins
    with gap g)^2 becomes smallest; ties take the fullest bin, an open bin
    before a new one. Returns each length's bin and offset, and the number of
    bins. The state is one counter and one stack of bins per residual gap.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    made = 0
    far = np.iinfo(np.int64).max
    for k, s in enumerate(lengths.tolist()):
        # moving a bin from gap g to g - s changes the sum by
        # 2 * (count[g - s] - count[g] + 1); one that becomes full leaves it
        old = count[s:]
        change = np.where(old > 0, 2 * (count[:capacity + 1 - s] - old + 1), far)
        change[0] = 1 - 2 * old[0] if old[0] else far
        g = int(np.argmin(change))
        fresh = 2 * count[capacity - s] + 1 if s < capacity else 0
        if change[g] <= fresh:
            gap = s + g
            b = stacks[gap].pop()
            count[gap] -= 1
        else:
            gap, b, made = capacity, made, made + 1
        bins[k], offsets[k] = b, capacity - gap
        if gap > s:
            stacks[gap - s].append(b)
            count[gap - s] += 1
    return bins, offsets, made


def pack(pieces: DataFrame, capacity: int = 2048, per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """``pieces`` (as from ``tokenize_pieces``) with ``sequence_id`` and
    ``offset``: each sequence holds at most ``capacity`` ids, gapless from 0.

    Full pieces are sequences of their own and never move. The others are
    dealt at random into groups of about ``per_group`` pieces and each group
    is packed by sum of squares: pieces of a quarter sequence and more from
    the longest down, then the rest in random order, which leaves about a
    fifth of a per cent more sequences than the ids need. Only a group's
    lengths and places are in memory. Repeated rows are packed as often as
    they occur; a null doc_id is kept; an empty input gives an empty result.
    """
    pieces = stage(pieces.withColumn("_id", F.monotonically_increasing_id()), "pieces")
    short = F.col("length") < capacity
    n = pieces.where(short).count()
    groups = max(1, -(-n // per_group))
    width = 40  # sequence_id = group in the high bits, bin in the low ones
    # only numbers and lengths are placed; a number is dealt, so that equal rows spread
    dealt = pieces.where(short).select("_id", "length", F.pmod(F.xxhash64("_id"), F.lit(groups)).cast("int").alias("_g"))

    def place(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_id", kind="stable")
        group = group.iloc[np.random.default_rng(0).permutation(len(group))]
        rank = -group.length.where(group.length >= capacity // 4, 0)
        group = group.iloc[np.argsort(rank.to_numpy(), kind="stable")]
        bins, offsets, _ = sum_of_squares(group.length.to_numpy(), capacity)
        return pd.DataFrame({"_id": group["_id"].to_numpy(), "sequence_id": (int(key[0]) << width) + bins, "offset": offsets})

    placed = dealt.groupBy("_g").applyInPandas(place, "_id long, sequence_id long, offset long")
    full = pieces.where(~short).withColumns({"sequence_id": F.lit(1 << 62) + F.col("_id"), "offset": F.lit(0).cast("long")})
    return pieces.where(short).join(placed, "_id").unionByName(full).drop("_id")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences of ``pack``'s pieces with ids: ``sequence_id,
    length, parts`` (offset, doc_id, piece, start, length of each piece, in
    order) and ``ids``. A sequence holds at most its capacity of ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"), F.sum("length").alias("length"))
    # Latin-1 maps bytes to characters one to one: joined as text, which takes linear time
    joined = F.array_join(F.transform("parts", lambda p: F.decode(p["ids"], "ISO-8859-1")), "")
    return rows.select("sequence_id", "length", F.transform("parts", lambda p: p.dropFields("ids")).alias("parts"),
                       F.encode(joined, "ISO-8859-1").alias("ids"))


@F.pandas_udf(ArrayType(IntegerType()))
def id_array(ids: pd.Series) -> pd.Series:
    """Packed ids as numbers."""
    return pd.Series([np.frombuffer(x, dtype="<i4") for x in ids])


def unpacked(rows: DataFrame) -> DataFrame:
    """The pieces of ``sequences``, each read from its place in the ids:
    ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    at, n = F.col("p.offset").cast("int") * 4 + 1, F.col("p.length").cast("int") * 4
    return described(rows.select("sequence_id", F.explode("parts").alias("p"), "ids").select(
        "p.*", "sequence_id", F.substring("ids", at, n).alias("ids")))


def described(packed: DataFrame) -> DataFrame:
    """Pieces with what their ids say: ``doc_id, piece, start, length,
    ids_crc32, sequence_id, offset``."""
    return packed.select("doc_id", "piece", "start", F.shiftright(F.octet_length("ids"), 2).cast("long").alias("length"),
                         F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")
