"""Distributed union-find against a local one."""

import random

from medalla.llm.common import components


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5), (None, 7), (7, None)]
    root = {x: x for e in edges if None not in e for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in (e for e in edges if None not in e):
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {(x, find(x)) for x in root if find(x) != x}
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_concluded_releases_what_was_staged_on_the_way(spark):
    import os

    from medalla.llm.common import concluded, stage

    made = []

    def inner():
        made.append(stage(spark.range(5), "inner"))
        return made[0].selectExpr("id + 1 as id")

    def outer():
        made.append(concluded(inner, "inner-result"))
        return made[1].selectExpr("id * 2 as id")

    out = concluded(outer, "outer-result")
    assert sorted(r.id for r in out.collect()) == [2, 4, 6, 8, 10]
    assert not any(os.path.isdir(t.scratch_path.removeprefix("file:")) for t in made)


def test_workers_give_back_what_they_free(spark):
    """What a batch needed is not held by its worker afterwards."""
    from medalla.llm.common import importable

    importable(spark)

    def run(batches):
        import numpy as np
        import pandas as pd

        def held():
            with open("/proc/self/statm") as f:
                return int(f.read().split()[1]) * 4096 / 2**20

        for b in batches:
            np.ones(3 << 20, np.uint8)  # 3 MB once mapped and freed: such arrays would come from the heap from now on
            before = held()
            arrays = [np.ones(2 << 20, np.uint8) for _ in range(60)]
            last = np.ones(200 << 10, np.uint8)  # above the others
            del arrays
            yield pd.DataFrame({"mb": [held() - before + 0 * len(last)]})

    assert spark.range(1).repartition(1).mapInPandas(run, "mb double").first().mb < 20
