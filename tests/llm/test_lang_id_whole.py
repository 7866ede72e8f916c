"""Language ID without caps: every order of a large alphabet stays, contexts
sum to one, ranges and a small memory give the same values."""

import random

import numpy as np
import pytest

from medalla.llm import lang_id


@pytest.fixture(scope="module")
def large(spark):
    rng = np.random.default_rng(3)
    han = "".join(map(chr, rng.integers(0x4E00, 0x4E00 + 15_000, 130_000)))
    rows = [(han, "zh"), ("the cat sat on the mat and the rat ran to the hat " * 40, "en")]
    return han, lang_id.train(spark.createDataFrame(rows, "text string, lang string"), per_range=20_000)


def test_every_order_of_a_large_alphabet_stays(large):
    han, model = large
    ranges = lang_id.Ranges(model)
    zh = model.langs.index("zh")
    assert max(model.bits) > 2
    for k in range(1, lang_id.ORDER + 1):
        kept = sum(len(ranges.arrays(k, r)[zh][0]) for r in range(1 << model.bits[k - 1]))
        grams = {han[i:i + k] for i in range(len(han) - k + 1)}
        assert kept >= len(grams)
        some = np.array([[ord(c) for c in g] for g in sorted(grams)[:500]], np.uint32)
        assert (ranges.find(k, lang_id.hashes(some, k), -1.0)[:, zh] >= 0).all()


def test_probabilities_of_a_context_sum_to_one(large):
    han, model = large
    kinds = sorted({*map(ord, han), *map(ord, "the cat sat on the mat and the rat ran to the hat ")})
    for context in (han[1000:1004], han[:4], "the ", "zzzz"):
        chars = np.array([[*map(ord, context), c] for c in kinds], np.uint32)
        p = np.exp(lang_id.log_probs(model, chars)).sum(axis=0)
        # what is left goes to characters never seen: 1 / (alphabet + 1) of the lowest order
        assert (p <= 1 + 1e-4).all() and (p > 0.9).all()


def test_small_memory_gives_the_same(large, monkeypatch):
    han, model = large
    chars = np.lib.stride_tricks.sliding_window_view(lang_id.normalise(han[:3000]), lang_id.ORDER)
    whole = lang_id.log_probs(model, chars)
    monkeypatch.setattr(lang_id, "HELD_BYTES", 1)
    ranges = lang_id.Ranges(model)
    assert (lang_id.log_probs(model, chars, ranges) == whole).all()
    assert len(ranges.held) == 1


def test_one_limit_at_every_number_of_rows(spark):
    rows = [("en", "en", 2.0 + (i % 10) / 100, 100 * 2 ** (i % 6)) for i in range(600)]
    few = spark.createDataFrame(rows[:60], "lang string, lang_pred string, nats double, n_letters long")
    many = spark.createDataFrame(rows, few.schema)
    probe = spark.createDataFrame([("en", "en", nats, n) for n in (3, 50, 5_000, 5_000_000) for nats in (2.1, 6.0)], few.schema)
    a, b = ([r.rejected for r in lang_id.with_rejection(probe, lang_id.calibrate(x)).orderBy("n_letters", "nats").collect()]
            for x in (few, many))
    assert a == b == [False, True] * 4


def test_a_worker_holds_little(spark, monkeypatch):
    """Places are handled a bounded number at a time, and the n-grams that
    are remembered are forgotten in time, with the same figures."""
    text = "the quick brown fox jumps over it " * 20_000
    assert max(len(c) for c, _, _ in lang_id.chunks([text])) <= 300_000
    rnd = random.Random(4)
    texts = ["".join(rnd.choice("abcdefg hij") for _ in range(300)) for _ in range(12)]
    model = lang_id.train(spark.createDataFrame([(t, "x" if i % 2 else "y") for i, t in enumerate(texts)], "text string, lang string"))
    want = lang_id.cross_entropies(model, texts, {}, lang_id.Ranges(model))
    monkeypatch.setattr(lang_id, "REMEMBERED", 700)
    memo = {}
    for i, t in enumerate(texts):
        ce, n = lang_id.cross_entropies(model, [t], memo, lang_id.Ranges(model))
        assert abs(ce[0] - want[0][i]).max() < 1e-12 and n[0] == want[1][i]
        assert len(memo["keys"]) == len(memo["vals"]) <= 700
        assert (memo["keys"][1:] > memo["keys"][:-1]).all()
