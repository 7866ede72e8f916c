"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors with cosine >= t lie within epsilon = sqrt(2 - 2t) of each other,
and so do their coordinates on any orthonormal axes. Vectors are sorted by the
grid cells (edge epsilon) of their leading principal coordinates, cut into
blocks of that sequence. The sequence is joined with itself by recursion over
its intervals, those whose bounding boxes are over epsilon apart being skipped,
down to pairs of blocks, which are halved again and again in the same way
before cosines are taken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalla.llm.common import components, stage

#: vectors of a block, and those below which an interval is not halved
BLOCK, LEAF = 256, 32
#: bits by which an interval of blocks is cut in a round
FAN = 4
#: principal axes of the grid
AXES = 12
#: vectors, at most, that the axes are fitted on; axes only decide what is skipped
SAMPLE = 4096


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows as doubles, each divided by its largest magnitude: cosines are
    the same and no square can overflow."""
    a = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    return a / np.abs(a).max(axis=1, keepdims=True)


def axes(vectors: DataFrame, count: int = AXES, sample: int = SAMPLE) -> np.ndarray:
    """Leading principal axes, as columns, of the ``sample`` unit vectors with
    the lowest hashes in ``vectors(dim, embedding)`` of the commonest dim."""
    dim = vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if dim is None:
        return np.zeros((0, 0))
    rows = (vectors.where(F.col("dim") == dim.dim).orderBy(F.xxhash64("embedding")).limit(sample)
            .select("embedding").toPandas())
    u = _matrix(rows.embedding)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    _, _, v = np.linalg.svd(u - u.mean(axis=0), full_matrices=False)
    return v[:count].T


def _project(u: np.ndarray, basis: np.ndarray, count: int) -> np.ndarray:
    """Coordinates on the axes; those of another dimension keep their own
    first ones. Missing ones are 0."""
    y = u @ basis if u.shape[1] == basis.shape[0] else u[:, :count]
    return np.pad(y, ((0, 0), (0, count - y.shape[1]))) if y.shape[1] < count else y


def blocks(classes: DataFrame, basis: np.ndarray, eps: float) -> DataFrame:
    """``classes(node, label, dim, embedding, copies)`` in epsilon grid order,
    cut into blocks: ``block, label, dim, low, high`` (bounding box), ``n`` and
    the nodes, copies and vectors as bytes."""
    count = AXES

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, g in b.groupby("dim"):
                u = _matrix(g.embedding)
                u /= np.linalg.norm(u, axis=1, keepdims=True)
                grid = np.floor(_project(u, basis, count) / eps).astype(np.int32)
                yield g.assign(cell=list(grid))

    keyed = classes.mapInPandas(cells, classes.schema.simpleString()[7:-1] + ",cell:array<int>")
    order = ["label", "dim", "cell", "node"]
    parts = max(1, -(-classes.count() // (32 * BLOCK)))
    keyed = (keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .withColumn("part", F.spark_partition_id()))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made, held = 0, None

        def block(g):
            nonlocal made
            raw = _matrix(g.embedding)
            u = raw / np.linalg.norm(raw, axis=1, keepdims=True)
            y = _project(u, basis, count)
            made += 1
            return pd.DataFrame([{
                "block": (int(g.part.iloc[0]) << 32) + made, "label": g.label.iloc[0], "dim": int(g.dim.iloc[0]),
                "low": y.min(axis=0), "high": y.max(axis=0), "n": len(g), "nodes": g.node.to_numpy("<i8").tobytes(),
                "copies": g.copies.to_numpy("<i8").tobytes(), "vectors": raw.astype("<f8").tobytes()}])

        for b in batches:
            held = b if held is None else pd.concat([held, b], ignore_index=True)
            while len(held):
                same = ((held.label == held.label.iloc[0]) & (held.dim == held.dim.iloc[0])).to_numpy()
                run = len(same) if same.all() else int(np.argmin(same))
                if run == len(held) and run < BLOCK:
                    break  # the rest of this run may follow
                yield block(held.iloc[:min(run, BLOCK)])
                held = held.iloc[min(run, BLOCK):]
        if held is not None and len(held):
            yield block(held)

    label = classes.schema["label"].dataType.simpleString()
    return keyed.mapInPandas(cut, f"block long, label {label}, dim int, low array<double>, high array<double>, n int, "
                                  "nodes binary, copies binary, vectors binary")


def near_blocks(meta: DataFrame, eps: float) -> DataFrame:
    """Pairs ``(a, b)``, a <= b, of ``meta(block, label, dim, low, high)``
    whose boxes are within ``eps``.

    A block's number gives its place in the sequence, and each FAN bits fewer
    name an interval of 2^FAN times as many blocks, up to the whole sequence
    of a label. From there on every round cuts the intervals of a pair and
    keeps the parts whose boxes are within ``eps``; distant ones are skipped
    with all their blocks. A round is two equi-joins on the interval, in which
    a key has 2^FAN parts at most, so no task holds the blocks of a label.
    """
    part, made = F.shiftright("block", 32), F.col("block").bitwiseAND((1 << 32) - 1)
    most = meta.agg(F.max(part), F.max(made)).first()
    if most[0] is None:
        return meta.select(F.col("block").alias("a"), F.col("block").alias("b"))
    width = int(most[1]).bit_length()
    code = F.shiftleft(part, width).bitwiseOR(made)
    rounds = -(-(int(most[0]).bit_length() + width) // FAN)

    def side(level: int, name: str) -> DataFrame:
        n = F.shiftright(code, FAN * level) if level else code
        boxes = meta.groupBy("label", "dim", n.alias("n")).agg(
            F.array(*(F.min(F.col("low")[i]) for i in range(AXES))).alias("low"),
            F.array(*(F.max(F.col("high")[i]) for i in range(AXES))).alias("high"))
        return boxes.select("label", "dim", F.shiftright("n", FAN).alias(name),
                            *(F.col(c).alias(f"{name}_{c}") for c in ("n", "low", "high")))

    gap = F.zip_with(F.arrays_zip("a_low", "a_high"), F.arrays_zip("b_low", "b_high"),
                     lambda x, y: F.greatest(F.lit(0.0), x["a_low"] - y["b_high"], y["b_low"] - x["a_high"]))
    square = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)
    zero = F.lit(0).cast("long")
    pairs = meta.select("label", "dim", zero.alias("a"), zero.alias("b")).distinct()
    for level in reversed(range(rounds)):
        pairs = pairs.join(side(level, "a"), ["label", "dim", "a"]).join(side(level, "b"), ["label", "dim", "b"])
        pairs = stage(pairs.where("a_n <= b_n").where(square <= eps * eps).select(
            "label", "dim", F.col("a_n").alias("a"), F.col("b_n").alias("b")), "vec-intervals")

    def block(c: str):
        return F.shiftleft(F.shiftright(c, width), 32).bitwiseOR(F.col(c).bitwiseAND((1 << width) - 1)).alias(c)

    return pairs.select(block("a"), block("b"))


def join_blocks(av: np.ndarray, bv: np.ndarray, ay: np.ndarray, by: np.ndarray, same: bool, cosine: float,
                eps: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with at least ``cosine`` between two sequence intervals,
    found by halving: intervals whose boxes are over ``eps`` apart are left
    out. With ``same`` each pair comes once and none with itself."""
    an, bn = np.linalg.norm(av, axis=1), np.linalg.norm(bv, axis=1)
    todo = [(0, len(av), 0, len(bv))]
    while todo:
        i, k, j, m = todo.pop()
        if same and m <= i:
            continue
        gap = np.maximum(0, np.maximum(ay[i:k].min(0) - by[j:m].max(0), by[j:m].min(0) - ay[i:k].max(0)))
        if gap @ gap > eps * eps:
            continue
        if k - i <= LEAF and m - j <= LEAF:
            cos = (av[i:k] @ bv[j:m].T) / (an[i:k, None] * bn[None, j:m])
            x, y = np.nonzero(cos >= cosine)
            x, y = x + i, y + j
            if same:
                x, y = x[x < y], y[x < y]
            yield x, y
        elif k - i >= m - j:
            h = (i + k) // 2
            todo += [(i, h, j, m), (h, k, j, m)]
        else:
            h = (j + m) // 2
            todo += [(i, k, j, h), (i, k, h, m)]


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """One row per row of ``vectors(vec_id, embedding, label)``: ``vec_id,
    n_links, component_id, kept``.

    Two vectors are linked when their labels are equal and not null and their
    cosine, in double precision, is at least ``cosine`` (above 0). ``n_links``
    counts the other rows linked directly; ``component_id`` is the smallest
    vec_id reachable; ``kept`` is vec_id = component_id. Null, empty and zero
    vectors, those with a null or non-finite component, and those without a
    label link with nothing; vectors of different length never link. Equal
    vectors of a label are one node with a count, so copies make no pairs:
    a task sends on one count and one tie per node of its blocks, not links.
    Rows that repeat a vec_id are one node; a null vec_id is counted and tied
    as any other but never names a component nor is kept. Other columns are
    ignored; an empty table gives an empty result.
    """
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-6
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding").withColumn(
        "usable", F.coalesce(F.col("label").isNotNull() & ~bad & some, F.lit(False)))
    rows = rows.withColumns({h: F.when(F.col("usable"), F.xxhash64("label", "embedding", F.lit(i)))
                             for i, h in enumerate(("node", "h2"))})
    classes = stage(rows.where("usable").groupBy("node", "h2").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("copies"),
        F.min("vec_id").alias("low")).withColumn("dim", F.size("embedding")), "vec-classes")
    basis = axes(classes.select("dim", "embedding"))
    block = stage(blocks(classes.select("node", "label", "dim", "embedding", "copies"), basis, eps), "vec-blocks")
    pairs = stage(near_blocks(block.select("block", "label", "dim", "low", "high"), eps), "vec-block-pairs")
    data = block.select("block", "dim", "n", "nodes", "copies", "vectors")
    left, right = (data.select(*(F.col(c).alias(f"{s}_{c}") for c in data.columns)) for s in "ab")
    both = pairs.join(left, F.col("a") == F.col("a_block")).join(right, F.col("b") == F.col("b_block"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                sides = []
                for s in "ab":
                    n = getattr(r, f"{s}_n")
                    v = np.frombuffer(getattr(r, f"{s}_vectors"), "<f8").reshape(n, -1)
                    u = v / np.linalg.norm(v, axis=1, keepdims=True)
                    sides.append((np.frombuffer(getattr(r, f"{s}_nodes"), "<i8"),
                                  np.frombuffer(getattr(r, f"{s}_copies"), "<i8"), v, _project(u, basis, AXES)))
                (an, ac, av, ay), (bn, bc, bv, by) = sides
                same = r.a == r.b
                found = [p for p in join_blocks(av, bv, ay, by, same, cosine, eps) if len(p[0])]
                if not found:
                    continue
                x, y = (np.concatenate(p) for p in zip(*found))
                shift = 0 if same else len(an)
                node = an if same else np.concatenate([an, bn])
                add = np.zeros(len(node), np.int64)
                np.add.at(add, x, bc[y])
                np.add.at(add, y + shift, ac[x])
                tie = np.arange(len(node))
                while True:  # smallest place reachable within the two blocks
                    was = tie.copy()
                    np.minimum.at(tie, x, was[y + shift])
                    np.minimum.at(tie, y + shift, was[x])
                    tie = tie[tie]
                    if (tie == was).all():
                        break
                hit = add > 0
                yield pd.DataFrame({"node": node[hit], "add": add[hit], "tie": node[tie[hit]]})

    # one pair of blocks per Arrow batch is a few hundred kilobytes
    found = stage(both.select("a", "b", *(f"{s}_{c}" for s in "ab" for c in ("n", "nodes", "copies", "vectors")))
                  .mapInPandas(join, "node long, add long, tie long"), "vec-links")
    root = components(found.select(F.col("node").alias("a"), F.col("tie").alias("b")).unionByName(_same_id(rows)),
                      "vec-cc")
    links = found.groupBy("node").agg(F.sum("add").alias("links"))
    rooted = stage(classes.join(links, "node", "left").join(root, "node", "left").select(
        "node", "h2", "low", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "vec-roots")
    named = rooted.join(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "root")
    out = rows.join(named.select("node", "h2", "n_links", "component_id"), ["node", "h2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _same_id(rows: DataFrame) -> DataFrame:
    """Ties between the nodes of rows that share a vec_id."""
    ids = rows.where("usable").groupBy("vec_id").agg(F.min("node").alias("a"), F.max("node").alias("z"))
    ids = ids.where("a <> z").drop("z")
    return rows.where("usable").join(ids, "vec_id").select("a", F.col("node").alias("b"))
