"""Prefix trie against a brute-force trie."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from medalla.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    seqs = {}
    for c, ts in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs[c] = convs.get(c - c % 20, [])[:h] + ts[h:]
    members = {}
    for c, ts in seqs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)

    def under(p):
        out = [p]
        for k in out:
            out += kids.get(k, [])
        return out

    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(seqs[c]) == len(p))
        sub = under(p)
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids.get(p, [])),
                    sum(k not in kids for k in sub),
                    sum((len(members[k]) - 1) * len(WORD.findall(k[-1][1])) for k in sub if k),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit("x"), "seq": F.lit(1)})
    return sorted((tuple(r) for r in pt.prefix_trie(df).collect()), key=str)


def few_texts(seed, convs=60, symbols=3, longest=7):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), r.choice(["", "a b", "c\td e", " "][:symbols]))
            for c in range(convs) for t in range(r.randrange(1, longest))]


@pytest.mark.parametrize("seed,symbols,longest", [(1, 1, 4), (2, 2, 7), (3, 4, 3)])
def test_against_brute_force(spark, seed, symbols, longest):
    rows = few_texts(seed, 60, symbols, longest)
    assert run(spark, rows) == brute(rows)


def test_hot_conversation_and_chains_over_boundaries(spark):
    # a third of all conversations equal, others extend each other over the range boundaries
    rows = [(c, t, "user", f"same {t}") for c in range(0, 40) for t in range(5)]
    rows += [(c, t, "user", "x") for c in range(100, 160) for t in range(c - 99)]
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_and_empty(spark):
    rows = [(1, None, "user", "late"), (1, None, None, None), (1, 3, "user", "b"), (1, 3, "user", "a"), (1, 3, "user", "a"),
            (None, 1, "user", "x"), (0, 0, "system", "s " * 100_000), (5, 0, None, ""), (45, 0, "user", "q"), (21, 1, "user", "r")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0]) == []


def test_forest_of_parts_adds_up():
    # Any cut of a sorted list of sequences gives the sums of the whole
    r = random.Random(4)
    seqs = sorted({bytes(b for _ in range(r.randrange(6)) for b in [r.randrange(2)] * pt.KEY) for _ in range(40)})
    words = [[1 + s[i] for i in range(0, len(s), pt.KEY)] for s in seqs]
    n = [r.randrange(1, 4) for _ in seqs]

    def named(lo, hi):
        left = pt.lcp(seqs[lo - 1], seqs[lo]) if lo else -1
        right = pt.lcp(seqs[hi - 1], seqs[hi]) if hi < len(seqs) else -1
        f = pt.Forest(seqs[lo:hi], n[lo:hi], list(range(lo, hi)), words[lo:hi], left, right)
        out = {}
        for v in range(len(f.depth)):
            u = f.parent[v]
            for j in range(f.depth[u] + 1 if u >= 0 else 0, f.depth[v] + 1):
                total, once = f.below(v, j)
                name = seqs[lo + f.rep[v]][:j * pt.KEY]
                assert name not in out
                out[name] = (f.n[v], f.kids[v] if j == f.depth[v] else int(f.begun(v, j + 1)), f.leaves[v], total - once)
        return out

    whole = named(0, len(seqs))
    for cuts in ([7], [1, 2, 3], [5, 9, 10, 14], list(range(1, len(seqs)))):
        got = {}
        for lo, hi in zip([0, *cuts], [*cuts, len(seqs)]):
            for name, x in named(lo, hi).items():
                got[name] = tuple(a + b for a, b in zip(got.get(name, (0,) * 4), x))
        assert got == whole
