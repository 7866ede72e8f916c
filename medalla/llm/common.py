"""Helpers that several operators of this package share."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medalla.session import materialize, release, scratch_root

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: what glibc and Arrow read in a Python worker's environment: freed arrays go
#: back to the machine at once, instead of staying with a worker that is idle
_FREED = {"MALLOC_MMAP_THRESHOLD_": "131072", "MALLOC_TRIM_THRESHOLD_": "131072", "MALLOC_ARENA_MAX": "2",
          "ARROW_DEFAULT_MEMORY_POOL": "system"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver found it
    (a cluster ships it with --py-files, or has it installed), and has them
    give back the memory that they no longer use. What is set already stays."""
    env = spark.sparkContext.environment
    for k, v in _FREED.items():
        env.setdefault(k, v)
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join(p for p in (_ROOT, *paths) if p)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: tables staged inside each ``concluded`` that is under way
_staged: list[list[DataFrame]] = []


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    out = materialize(df, label)
    for made in _staged:
        made.append(out)
    return out


def concluded(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` returns, staged; the tables that were staged on the way,
    which nothing but the result reads, are released."""
    _staged.append([])
    try:
        out = materialize(make(), label)
    finally:
        made = _staged.pop()
    release(*made)
    for outer in _staged:
        outer.append(out)
    return out


def ascii_lower(text: Column | str) -> Column:
    """Lower-cases A-Z only."""
    return F.translate(text, UPPER, LOWER)


def text_id(text: Column | str) -> list[Column]:
    """Two 64-bit hashes that together stand for a text (128 bits)."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(text, F.lit(1)).alias("t2")]


def per_batch(fn: Callable[[pd.DataFrame], pd.DataFrame]):
    """Turns a function on one pandas batch into one for ``mapInPandas``."""
    @functools.wraps(fn)
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield fn(b)
    return run


def components(edges: DataFrame, label: str = "cc") -> DataFrame:
    """Connected components of the undirected graph ``edges(a, b)`` (bigint).

    Distributed union-find by alternating stars: each round links every
    larger neighbour of a node to the smallest node it sees (large star) and
    then every smaller neighbour likewise (small star), until no edge
    changes; O(log^2 n) rounds. The minima are pre-aggregated, so a node
    holding a third of the edges costs no more than the others; the edges are
    joined to their one-row-per-node minimum, which AQE may split. Each round
    is a written table, so nothing is recomputed when an executor is lost; the
    one before it is released then. The edges only ever move to smaller ends,
    so the rounds come to an end whatever the graph.

    Returns ``(node, root)`` for every node of an edge other than the roots
    themselves, ``root`` being the smallest node of the component. Null ends
    and loops are ignored; an empty input gives an empty result.
    """
    e = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .where("a is not null and b is not null and u <> v").distinct())
    e = stage(e, label)

    def star(e: DataFrame, both: bool) -> DataFrame:
        ends = e
        if both:
            ends = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = ends.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        j = ends.join(low, "u")
        if both:  # larger neighbours of u go to the smallest node u sees
            out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # u and its smaller neighbours go to the smallest of them
            out = (j.select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .unionByName(low.select("u", F.col("m").alias("v"))))
        return out.where("u <> v").distinct()

    while True:
        n = stage(star(star(e, True), False), label)
        a, b = (x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for x in (e, n))
        release(e)
        e = n
        if a == b:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


__all__ = ["ascii_lower", "components", "concluded", "per_batch", "read", "release", "scratch_root", "stage", "text_id"]
