"""Distributed rank / quantiles / running sum equal their single-task forms."""

import random

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from medalla.operators.ordering import exact_quantiles, global_rank, running_total


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    # many ties on v, and one value holding a third of the rows
    rows = [(i, rnd.choice("abc"), 1 if i % 3 == 0 else rnd.randint(1, 40)) for i in range(n)]
    return spark.createDataFrame(rows, "k long, g string, v long")


def test_global_rank_equals_row_number(spark):
    df = _data(spark)
    got = global_rank(df, [F.col("v").desc(), F.col("k").asc()], "r")
    ref = df.withColumn("r2", F.row_number().over(Window.orderBy(F.col("v").desc(), F.col("k").asc())))
    bad = got.join(ref, "k").filter(F.col("r") != F.col("r2")).count()
    assert bad == 0
    assert got.agg(F.min("r"), F.max("r"), F.countDistinct("r")).first() == (1, 3000, 3000)


def test_partitioned_rank(spark):
    df = _data(spark)
    got = global_rank(df, [F.col("v").desc(), F.col("k").asc()], "r", partition_by=["g"])
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("k").asc())
    ref = df.withColumn("r2", F.row_number().over(w))
    assert got.join(ref, ["k", "g"]).filter(F.col("r") != F.col("r2")).count() == 0


def test_exact_quantiles_match_numpy(spark):
    df = _data(spark)
    probs = (0.0, 0.25, 0.5, 0.9, 0.95, 1.0)
    got = {(r.g, r.p): r.value for r in exact_quantiles(df, "g", "v", probs).collect()}
    pdf = df.toPandas()
    for g, part in pdf.groupby("g"):
        for p in probs:
            assert abs(got[(g, p)] - np.quantile(part.v.to_numpy(dtype=float), p)) < 1e-9


def test_running_total_matches_cumsum(spark):
    df = _data(spark)
    got = running_total(df, "v", [F.col("v").desc(), F.col("k").asc()])
    pdf = df.toPandas().sort_values(["v", "k"], ascending=[False, True])
    expect = dict(zip(pdf.k, pdf.v.cumsum()))
    for r in got.select("k", "acumulado", "posicion").collect():
        assert r.acumulado == expect[r.k]


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (2, None, 3), (3, "a", 1), (4, "a", None)], "k long, g string, v long")
    got = {r.k: r.r for r in global_rank(df, [F.col("v").desc(), F.col("k").asc()], "r", partition_by=["g"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 2}
    q = {(r.g, r.p): r.value for r in exact_quantiles(df, "g", "v", (0.0, 0.5, 1.0)).collect()}
    assert q == {(None, 0.0): 3.0, (None, 0.5): 4.0, (None, 1.0): 5.0, ("a", 0.0): 1.0, ("a", 0.5): 1.0, ("a", 1.0): 1.0}


def test_quantiles_of_many_distinct_values(spark, monkeypatch):
    """Brackets far narrower than the data, and ones that fail their proof."""
    from medalla.operators import ordering

    df = spark.range(50_000).select(F.lit("g").alias("g"), (F.hash("id") % 100_003).cast("double").alias("v"))
    values = np.sort(df.toPandas().v.to_numpy())
    for sketch in (2000, 10):
        monkeypatch.setattr(ordering, "SKETCH", sketch)
        for r in exact_quantiles(df, "g", "v", (0.01, 0.25, 0.5, 0.99)).collect():
            assert abs(r.value - np.quantile(values, r.p)) < 1e-9


def test_released_tables_leave_the_disk(spark):
    import os

    from medalla.session import materialize, release

    one = materialize(spark.range(10), "released")
    two = materialize(one.selectExpr("id * 2 as id"), "kept")
    folder = one.scratch_path.removeprefix("file:")
    assert os.path.isdir(folder)
    release(one)
    assert not os.path.isdir(folder) and two.count() == 10
