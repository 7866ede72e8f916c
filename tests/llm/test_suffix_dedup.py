"""Repeated passages against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from medalla.llm import suffix_dedup as sd


def brute(texts, window):
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i:i + window] for b in data for i in range(len(b) - window + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if count[b[i:i + window]] > 1:
                gone[i:i + window] = True
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest))
    return out


def fixture(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(rnd.randrange(20, 90)) for _ in range(6)]
    out = []
    for _ in range(120):
        t = text(rnd.randrange(0, 60))
        for _ in range(rnd.randrange(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randrange(0, 30)
            t += p[a:len(p) - rnd.randrange(0, 30)] + text(rnd.randrange(0, 20))
        out.append(t)
    base = text(200)
    for _ in range(40):  # near copies
        w = base.split(" ")
        for _ in range(rnd.randrange(0, 6)):
            w[rnd.randrange(len(w))] = word()
        out.append(" ".join(w))
    out += [out[3], out[3], None, "", "x", "ab" * 400, "z" * 900, "漢" * 200, text(3000) + base + base]
    return out


@pytest.mark.parametrize("window, group", [(200, sd.GROUP), (200, 1), (64, 3), (20, sd.GROUP)])
def test_against_brute_force(spark, window, group):
    texts = fixture(window)
    df = spark.createDataFrame([(i if i % 7 else None, t, 1, "x") for i, t in enumerate(texts)],
                               "doc_id long, text string, key int, kept string")
    got = sd.remove_repeats(df, window, group).collect()
    want = brute(texts, window)
    rows = [(r.text or "", r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in got]
    assert sorted(rows) == sorted((t or "", *w) for t, w in zip(texts, want))
    assert sum(w[1] for w in want) > 1000


def test_runs_cover_every_window_once():
    texts = [t.encode() for t in fixture(1) if t]
    t, first, n, seed, content = sd.runs(texts, 50)
    got = Counter((i, f + k) for i, f, m in zip(t, first, n) for k in range(m))
    assert got == Counter((i, k) for i, b in enumerate(texts) for k in range(len(b) - 49))


def test_leftmost_min_and_its_bounded_arrays():
    rnd = np.random.default_rng(5)
    h = rnd.integers(0, 40, 3000).astype(np.uint64) << np.uint64(32) | rnd.integers(0, 2**32, 3000).astype(np.uint64)
    upper = h >> np.uint64(32)  # many ties above different lower halves
    for width in (1, 2, 7, 169):
        want = [i + int(np.argmin(upper[i:i + width])) for i in range(len(h) - width + 1)]
        assert sd.leftmost_min(h, width).tolist() == want
    assert sd.CHUNK * 8 <= 1 << 20  # an array of a chunk's hashes fits a core's cache


def test_empty(spark):
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
