"""Prefix trie of conversations by union-find over sorted neighbours.

Conversations become sequences of 128-bit turn keys. Sorted, each pair of
neighbours has a longest common prefix (LCP); joining neighbours in
descending LCP makes a branching node at every merge. Each range partition
of the sorted sequences builds its forest so; what it shares with the
sequences beyond its ends is contracted to one record per depth, and those
records are merged along runs of partitions whose boundaries share the depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalla.llm.common import stage
from medalla.session import shuffle_partitions

KEY = 16  # bytes of a turn's key
NONE = hashlib.sha256(b"").hexdigest()
_WORD = r"[^\x20\x09-\x0D]+"


def turn_key(role: Column, text: Column) -> Column:
    """128 bits that stand for a turn's role and text."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))


def turn_lists(rows: DataFrame) -> DataFrame:
    """``(conv_id, turns)`` of ``rows(conv_id, turn, role, text)``: the turns
    in order, each ``(key, words)``. Only keys and word counts are gathered."""
    none = F.lit("")
    t = rows.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), none).alias("role"), F.coalesce(F.col("text").cast("string"), none).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    t = t.select("conv_id", F.row_number().over(order).alias("pos"), turn_key(F.col("role"), F.col("text")).alias("key"),
                 F.regexp_count("text", F.lit(_WORD)).cast("long").alias("words"))
    turns = F.sort_array(F.collect_list(F.struct("pos", "key", "words")))
    return t.groupBy("conv_id").agg(F.transform(turns, lambda x: F.struct(x["key"], x["words"])).alias("turns"))


def rebuilt(turns: DataFrame, block: int = 20, shared: int = 4) -> DataFrame:
    """Each conversation c of ``turns(conv_id, turns)`` with its first h turns
    taken from conversation c - c % ``block``, h = crc32(c) % ``shared``."""
    heads = turns.select(F.col("conv_id").alias("base"), F.slice("turns", 1, shared).alias("head"))
    rows = turns.withColumns({"base": F.expr(f"conv_id - conv_id % {block}"),
                              "h": F.expr(f"cast(crc32(cast(cast(conv_id as string) as binary)) % {shared} as int)")})
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return rows.join(heads, "base", "left").select("conv_id", F.concat(head, own).alias("turns"))


def _ends(members: DataFrame) -> DataFrame:
    """``(seq, ends_sha256)`` of ``members(seq, conv_id)``: digest of the ids
    in ascending order, comma-joined; sorted on disk and streamed."""
    rows = members.repartition("seq").sortWithinPartitions("seq", "conv_id")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = None, None
        for b in batches:
            out = []
            seqs = b.seq.to_numpy()
            edge = [0, *(np.flatnonzero(seqs[1:] != seqs[:-1]) + 1).tolist(), len(seqs)]
            for lo, hi in zip(edge, edge[1:]):
                ids = ",".join(map(str, b.conv_id.iloc[lo:hi].tolist()))
                if seqs[lo] != last:
                    if state:
                        out.append((last, state.hexdigest()))
                    last, state = seqs[lo], hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["seq", "ends_sha256"])
        if state:
            yield pd.DataFrame([(last, state.hexdigest())], columns=["seq", "ends_sha256"])

    return rows.mapInPandas(digest, "seq string, ends_sha256 string")


def lcp(a: bytes, b: bytes) -> int:
    """Turns at the start that two sequences share."""
    if a[:KEY] != b[:KEY]:
        return 0
    n = min(len(a), len(b)) // KEY
    x, y = (np.frombuffer(s, dtype="<u8", count=2 * n).reshape(n, 2) for s in (a, b))
    other = np.flatnonzero((x != y).any(axis=1))
    return int(other[0]) if len(other) else n


class Forest:
    """The trie of one sorted run of distinct sequences.

    Nodes 0 .. m-1 are the ends of the sequences, the others the merges of
    union-find. ``left``: turns the first sequence shares with the one before
    the run, or -1; a node there has begun before this run. ``right``: turns
    the last one shares with the one behind. Sums leave out what such nodes
    have elsewhere, so those of a node's parts add up.
    """

    def __init__(self, keys: list[bytes], n: list[int], conv: list[int], words: list[np.ndarray], left: int, right: int):
        m = len(keys)
        self.m, self.left, self.right = m, left, right
        self.sums = [np.concatenate(([0], np.cumsum(np.asarray(w, dtype=np.int64)))) for w in words]
        self.depth = [len(k) // KEY for k in keys]
        shared = [lcp(a, b) for a, b in zip(keys, keys[1:])]
        self.n, self.conv = list(n), list(conv)
        self.rep = list(range(m))  # a sequence below the node
        self.first, self.last = list(range(m)), list(range(m))
        # a sequence is childless unless it is the start of the next one
        self.leaves = [int(d != s) for d, s in zip(self.depth, [*shared, right])]
        self.total, self.once = [0] * m, [0] * m  # below the node: words times members, words of nodes begun here
        self.parent, self.kids = [-1] * m, [0] * m
        top = list(range(m))  # of a component's root: its topmost node
        up = list(range(m))

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        # at equal depth from left to right: then only the left component can have its node at that depth already
        for i in sorted(range(m - 1), key=lambda i: -shared[i]):
            a, b = find(i), find(i + 1)
            x = top[a]
            if self.depth[x] > shared[i]:
                x = self._over(x, shared[i])
            self._adopt(x, top[b])
            up[b], top[a] = a, x
        x = top[find(0)]
        self.root = self._over(x, 0) if self.depth[x] else x

    def begun(self, v: int, depth: int) -> bool:
        """Whether the node at ``depth`` over v has its first sequence here."""
        return self.first[v] > 0 or depth > self.left

    def open(self, v: int, depth: int) -> bool:
        return not self.begun(v, depth) or (self.last[v] == self.m - 1 and depth <= self.right)

    def _over(self, child: int, depth: int) -> int:
        v = len(self.depth)
        for field, value in ((self.depth, depth), (self.n, 0), (self.conv, self.conv[child]), (self.rep, self.rep[child]),
                             (self.first, self.first[child]), (self.last, self.last[child]), (self.leaves, 0),
                             (self.total, 0), (self.once, 0), (self.parent, -1), (self.kids, 0)):
            field.append(value)
        self._adopt(v, child)
        return v

    def _adopt(self, v: int, child: int) -> None:
        total, once = self.below(child, self.depth[v] + 1)
        self.parent[child] = v
        self.n[v] += self.n[child]
        self.conv[v] = min(self.conv[v], self.conv[child])
        self.last[v] = max(self.last[v], self.last[child])
        self.leaves[v] += self.leaves[child]
        self.total[v] += total
        self.once[v] += once
        self.kids[v] += self.begun(child, self.depth[v] + 1)

    def below(self, v: int, depth: int) -> tuple[int, int]:
        """Sums of the subtree whose top is the node at ``depth`` on the way
        down to v: words times members, and words of the nodes begun here."""
        s, d = self.sums[self.rep[v]], self.depth[v]
        lo = max(depth - 1, 0)
        fresh = lo if self.first[v] else min(max(lo, self.left), d)
        return (self.total[v] + self.n[v] * int(s[d] - s[min(lo, d)]), self.once[v] + int(s[d] - s[fresh]))

    def rows(self) -> Iterator[tuple]:
        """Every node, those without a branch included: ``(depth, where, conv,
        n, children, leaves, saved, end, parent's conv, where the parent
        is)``; children, leaves and saved are this run's share, ``where`` is
        None for a node of this run alone, else whether it begins here."""
        for v in range(len(self.depth)):
            u, d = self.parent[v], self.depth[v]
            for j in range(self.depth[u] + 1 if u >= 0 else 0, d + 1):
                total, once = self.below(v, j)
                above = u if u >= 0 and j == self.depth[u] + 1 else v
                yield (j, self.begun(v, j) if self.open(v, j) else None, self.conv[v], self.n[v],
                       self.kids[v] if j == d else int(self.begun(v, j + 1)), self.leaves[v], total - once,
                       v if v < self.m and j == d else -1, self.conv[above],
                       self.begun(above, j - 1) if j and self.open(above, j - 1) else None)


def _runs(lefts: dict[int, int], spans: dict[int, int]):
    """For partitions with ``lefts`` (turns shared with the one before) and
    ``spans`` (turns all their sequences share): the partition in which the
    node at some depth over a partition's first sequence begins."""
    parts = sorted(lefts)
    place = {p: i for i, p in enumerate(parts)}

    def begin(part: int, depth: int) -> int:
        i = place[part]
        while lefts[parts[i]] >= depth:
            i -= 1
            if spans[parts[i]] < depth:
                break
        return parts[i]

    return begin


def trie(sequences: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of ``sequences(conv_id, turns)``, as from
    ``rebuilt``.

    Per node: ``conv_id`` (smallest member), ``depth, parent_conv_id``
    (its parent's conv_id, null for the root), ``n_convs`` (members),
    ``n_children, n_leaves, saved_tokens`` (over its subtree, members less one
    times the words of the node's turn), ``ends_sha256`` (digest of the
    members that end here). Equal sequences are one before the sort, however
    many there are. A task holds the sequences of one range partition; no node
    is held with its members. The driver sees two numbers per partition.
    """
    spark = sequences.sparkSession
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), ""))
    rows = stage(sequences.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))
                 .withColumn("seq", F.md5("key")), "trie-sequences")
    distinct = rows.groupBy("seq").agg(F.first("key").alias("key"), F.first("words").alias("words"),
                                       F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
    distinct = distinct.join(_ends(rows.select("seq", "conv_id")), "seq")
    ordered = stage(distinct.repartitionByRange(shuffle_partitions(spark), "key").sortWithinPartitions("key")
                    .withColumn("part", F.spark_partition_id()), "trie-sorted")

    # one row per partition: the only thing ordered in one task
    before = Window.orderBy("part")
    edges = ordered.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    edges = edges.withColumn("before", F.lag("high").over(before))

    def boundary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"part": b.part, "left": [-1 if h is None else lcp(h, low) for h, low in zip(b.before, b.low)],
                                "span": [lcp(low, h) for low, h in zip(b.low, b.high)]})

    shared = edges.mapInPandas(boundary, "part int, left int, span int").collect()
    lefts, spans = ({r["part"]: r[c] for r in shared} for c in ("left", "span"))
    parts = sorted(lefts)
    rights = dict(zip(parts, [*(lefts[p] for p in parts[1:]), -1]))
    begin = _runs(lefts, spans)

    def grow(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        part, g = int(key[0]), g.sort_values("key", kind="stable")
        f = Forest(g.key.tolist(), g.n.tolist(), g.conv_id.tolist(), g.words.tolist(), lefts[part], rights[part])
        ends = g.ends_sha256.tolist()

        def run(depth: int, here: bool | None) -> int | None:
            return here if here is None else part if here else begin(part, depth)

        out = [(conv, j, over if j and wide is None else None, n, kids, leaves, saved, ends[end] if end >= 0 else None,
                run(j, where), run(j - 1, wide))
               for j, where, conv, n, kids, leaves, saved, end, over, wide in f.rows()]
        frame = pd.DataFrame(out, columns=names)
        return frame.astype({c: "Int64" for c in ("parent_conv_id", "run", "over")})

    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "run", "over"]
    schema = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in names)
    nodes = stage(ordered.groupBy("part").applyInPandas(grow, schema), "trie-forests")

    # contracted forests: a node that reaches over a boundary has one record per partition
    merged = nodes.where("run is not null").groupBy("run", "depth").agg(
        F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.max("ends_sha256").alias("ends_sha256"), F.max("over").alias("over"))
    merged = stage(merged, "trie-merged")
    parent = merged.select(F.col("run").alias("over"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("wide"))
    whole = nodes.where("run is null").drop("run").unionByName(
        merged.drop("run").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return whole.join(parent, ["over", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "wide").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(NONE)).alias("ends_sha256"))


def prefix_trie(rows: DataFrame) -> DataFrame:
    """``trie`` of the rebuilt conversations of ``rows(conv_id, turn, role,
    text)``.

    Turns are ordered by turn (null first), then role, then text, so ties and
    repeated rows have one order, each a turn of its own. Null role or text is
    the empty string. Rows without a conv_id belong to no conversation and are
    left out. Other columns are ignored. An empty table has no conversation,
    so no node, not even the root. A conversation is one row of 24 bytes a
    turn on its way; its texts are only ever hashed and counted.
    """
    return trie(rebuilt(turn_lists(rows)))
