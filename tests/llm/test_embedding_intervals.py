"""The recursion over sequence intervals finds the block pairs that comparing
all boxes finds."""

import random

from medalla.llm import embedding_dedup as E


def test_near_blocks_are_all_near_pairs(spark):
    r = random.Random(6)
    rows = []
    for label, parts in (("x", 37), ("y", 3), ("z", 1)):
        for p in range(parts):
            for made in range(1, r.randrange(2, 40)):
                low = [p / 10 + r.random() / 5, *(r.random() / 3 for _ in range(E.AXES - 1))]
                rows.append(((p << 32) + made, label, 8, low, [v + r.random() / 20 for v in low]))
    meta = spark.createDataFrame(rows, "block long, label string, dim int, low array<double>, high array<double>")
    eps = 0.6

    def near(a, b):
        return sum(max(0.0, x - v, y - w) ** 2 for x, w, y, v in zip(a[3], a[4], b[3], b[4])) <= eps * eps

    want = {(a[0], b[0], a[1]) for a in rows for b in rows if a[1] == b[1] and a[0] <= b[0] and near(a, b)}
    got = E.near_blocks(meta, eps).collect()
    assert len(got) == len(want) and {(x.a, x.b) for x in got} == {(a, b) for a, b, _ in want}
    assert len(rows) < len(want) < len(rows) ** 2 / 4
    assert E.near_blocks(meta.limit(0), eps).count() == 0
