"""Sharding by histogram sort: exact splitters from repeated counting, then
one exchange that brings every row, text and all, to its place in key order."""

from __future__ import annotations

import os.path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from medalla.llm.common import stage
from medalla.session import shuffle_partitions

#: hex digits by which each round refines an open interval (4096 probes)
DIGITS = 3


def sort_key(doc_id: Column, text: Column) -> Column:
    """A fixed-width string that sorts rows at random but equal texts
    together: the text's MD5, then doc_id (null first), both in hex."""
    flipped = doc_id.cast("long").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    return F.concat(F.md5(F.coalesce(text, F.lit(""))), F.coalesce(F.lpad(F.hex(flipped), 16, "0"), F.lit("")))


def splitters(keyed: DataFrame, shards: int, tolerance: float) -> list[str]:
    """Smallest keys with at least j/shards of all bytes below them, for
    j = 1..shards-1, from ``keyed(_key, _size)``.

    Each round counts, in one distributed aggregate, the bytes and the key
    range of every probe cell inside the intervals still open (at most
    shards-1 of them, ``16 ** DIGITS`` cells each: that bounds what comes to
    the driver), and keeps the cell each target falls into. A cell whose bytes
    are within ``tolerance`` of a shard, or that holds one key, is settled;
    otherwise the next round starts at the common prefix of its keys, so
    a text with a third of all rows costs one round. Keys are never split.
    """
    total = keyed.agg(F.sum("_size")).first()[0] or 0
    slack = tolerance * total / shards
    open_, found = {j: ("", 0) for j in range(1, shards)}, {}  # target -> (prefix, bytes below it)
    while open_ and total:
        prefixes = sorted({p for p, _ in open_.values()})
        inside = F.lit(False)
        cell = F.lit(None).cast("string")
        for p in prefixes:
            hit = F.col("_key").startswith(p)
            inside = inside | hit
            cell = F.when(hit, F.substring("_key", 1, len(p) + DIGITS)).otherwise(cell)
        cells = (keyed.where(inside).groupBy(cell.alias("cell"))
                 .agg(F.sum("_size").alias("b"), F.min("_key").alias("lo"), F.max("_key").alias("hi")).collect())
        cells.sort(key=lambda r: r.cell)
        nearer = {}
        for j, (prefix, below) in open_.items():
            for i, r in enumerate(own := [r for r in cells if r.cell.startswith(prefix)]):
                after = own[i + 1].lo if i + 1 < len(own) else r.hi + "0"  # just past the cell
                if below * shards >= j * total:
                    found[j] = r.lo
                elif (below + r.b) * shards < j * total:
                    below += r.b
                    continue
                elif r.lo == r.hi or r.b <= slack:
                    found[j] = after
                else:
                    nearer[j] = (os.path.commonprefix([r.lo, r.hi]), below)
                break
        open_ = nearer
    return [found[j] for j in sorted(found)]


def shard_by_bytes(docs: DataFrame, shards: int = 16, tolerance: float = 0.0) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of text, plus 1), ``shard`` and
    ``slot`` (gapless from 0 in each shard); shard sizes differ by about one
    row from equal at ``tolerance`` 0.

    A row's shard is the number of splitters at or below its key, so a row
    with x bytes before it goes to shard floor(x * shards / total), up to
    the row that straddles a boundary. Shards are sorted by key: ``slot``
    follows it, equal texts stand side by side, and where a splitter falls
    between copies of one text they go on in the next shard. Null and empty
    texts have size 1 and the same key but for doc_id; a null doc_id sorts
    first; rows equal in both share a key and stay in one shard; fewer rows
    than shards leave shards empty, an empty table gives an empty result.
    Columns named size, shard or slot are replaced; all others, whatever
    their names, are carried through the one exchange.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    key = sort_key(F.col("doc_id"), F.col("text"))
    keyed = stage(docs.select(key.alias("_key"), size.alias("_size")), "shard-keys")
    cuts = splitters(keyed, shards, tolerance)
    own = [c for c in docs.columns if c not in ("size", "shard", "slot")]
    # the row travels as one column, so that no name of its own clashes
    rows = docs.select(key.alias("key"), size.alias("size"), F.struct(*(F.col(f"`{c}`") for c in own)).alias("row"))
    shard = sum((F.when(F.col("key") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    # the exchange: ranges of keys, sorted, so a shard is a run of partitions
    rows = (rows.withColumn("shard", shard.cast("int"))
            .repartitionByRange(shuffle_partitions(docs.sparkSession), "shard", "key").sortWithinPartitions("shard", "key")
            .select("shard", "size", "row", F.monotonically_increasing_id().alias("at")))
    rows = stage(rows, "shards")
    # rows before each part of a shard: a table of partitions + shards rows at most
    part = F.shiftright("at", 33).alias("part")
    counts = rows.groupBy("shard", part).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "part", "first", (F.sum("n").over(
        W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    # broadcast: as few rows as that, so that the rows stay where they are
    return (rows.withColumn("part", part).join(F.broadcast(before), ["shard", "part"])
            .select("row.*", "size", "shard", (F.col("before") + F.col("at") - F.col("first")).alias("slot")))
