"""Tested lift and bootstrap of the concentration against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from medalla.operators import inference as I
from medalla.operators.ordering import step_up


def test_normal_tail(spark):
    xs = [0.0, 0.3, 1.0, 1.96, 3.0, 6.0, 30.0, 60.0]
    got = [r.p for r in spark.createDataFrame([(x,) for x in xs], "x double").select(I.normal_tail(F.col("x")).alias("p")).collect()]
    assert np.allclose(got, [math.erfc(x / math.sqrt(2)) / 2 for x in xs], rtol=1e-4, atol=8e-8)


def test_step_up_with_ties_and_nulls(spark):
    r = random.Random(4)
    ps = [round(r.random() ** 3, 2) for _ in range(400)] + [0.0, 1.0, None, None]
    df = spark.createDataFrame(list(enumerate(ps)), "k long, p double")
    known = sorted(p for p in ps if p is not None)
    want = {p: min(1.0, min(x * len(known) / (j + 1) for j, x in enumerate(known) if x >= p)) for p in known}
    got = step_up(df, "p", ["k"]).collect()
    assert len(got) == len(ps)
    for x in got:
        assert x.q is None if x.p is None else x.q == pytest.approx(want[x.p])


def test_lift_shrinks_and_finds_planted_cells(spark):
    r = random.Random(7)
    rows = [(r.choice("abcdef"), r.choice(["x", "y", "z", None])) for _ in range(6000)]
    rows += [("a", "x")] * 400 + [("rare", "y")]
    got = {(t.motivo, t.nombre_entidad): t for t in I.tested_lift(
        spark.createDataFrame(rows, "motivo string, nombre_entidad string")).collect()}
    assert len(got) == 25 and sum(t.quejas for t in got.values()) == len(rows)
    assert got["a", "x"].significativo and got["a", "x"].lift_ajustado > 1.3
    assert not got["rare", "y"].significativo and got["rare", "y"].lift_ajustado < got["rare", "y"].lift
    assert not got["b", None].lift_ajustado > 1.3
    assert I.tested_lift(spark.createDataFrame([], "motivo string, nombre_entidad string")).count() == 0


def test_replicates(spark):
    r = random.Random(3)
    rows = [(str(i), int(r.paretovariate(1.2) * 10), 5) for i in range(300)] + [(None, 5, 5), ("none", None, 5), ("nil", 0, 5)]
    df = spark.createDataFrame(rows, "k string, v long, other int")
    got = {x.replica: x for x in I.concentration_replicates(df, "v", ["k"], 20).collect()}
    weights = {(x.k, x.b): x.w for x in df.crossJoin(spark.range(1, 21).withColumnRenamed("id", "b")).select(
        "k", "b", I.poisson_weight(F.concat_ws("|", "k"), F.col("b").cast("int"), 1).alias("w")).collect()}
    assert 0.95 < np.mean(list(weights.values())) < 1.05 and 0.9 < np.var(list(weights.values())) < 1.1
    for b in range(21):
        sample = sorted((v for k, v, _ in rows if v is not None for _ in range(1 if b == 0 else weights[k, b])), reverse=True)
        n, total = len(sample), sum(sample)
        gini = sum(abs(x - y) for x in sample for y in sample) / (2 * n * total)
        whole, part = divmod(n * 20, 100)
        top = sum(sample[:whole]) + part / 100 * sample[whole]
        assert (got[b].entidades, got[b].quejas) == (n, total)
        assert got[b].gini == pytest.approx(gini, abs=2e-6)
        assert got[b].participacion_top == pytest.approx(100 * top / total, abs=2e-6)
    band = I.concentration(I.concentration_replicates(df, "v", ["k"], 20)).first()
    assert band.replicas == 20 and band.gini_inferior < band.gini < band.gini_superior + 0.1
    assert I.concentration_replicates(df.limit(0), "v", ["k"], 5).count() == 0


def test_digest_taken_once_a_draw(spark):
    plan = I.concentration_replicates(spark.createDataFrame([("a", 1)], "k string, v long"), "v", ["k"], 3)._jdf.queryExecution().optimizedPlan().toString()
    steps = [line for line in plan.splitlines() if "md5" in line]
    assert steps and all("Generate" in line and line.count("md5(") == 1 for line in steps)
