"""Language ID: the models' arithmetic, held-out accuracy, rejection."""

import math
from collections import Counter

import numpy as np
import pytest

from conftest import SF_ORACLE
from medalla.llm import lang_id, queries


def test_normalise():
    def text(t):
        return "".join(map(chr, lang_id.normalise(t)))
    pad = " " * (lang_id.ORDER - 1)
    assert text("Ab, c9!d") == pad + "ab c d "
    assert text("  ÄÖ ") == pad[:0] + pad + "äö "
    assert text("12 !?") == "" and text("") == ""


def test_chunks_cover_long_texts_once():
    texts = ["abc " * 700, None, "", "x", "de " * 900]
    whole = list(lang_id.chunks(texts, 1 << 20))
    parts = list(lang_id.chunks(texts, 100))
    assert len(whole) == 1 and len(parts) > 20
    assert (np.concatenate([p[0] for p in parts]) == whole[0][0]).all()


def kneser_ney(text, order, discount):
    """Probabilities of one language by the book."""
    grams = Counter(tuple(text[i - order + 1:i + 1]) for i in range(order - 1, len(text)))
    tables = {order: grams}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    alphabet = len(tables[1])

    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / (alphabet + 1)
        ctx = [(g, n) for g, n in tables[k].items() if g[:-1] == gram[:-1]]
        if not ctx:
            return p(gram[1:])
        total, kinds = sum(n for _, n in ctx), len(ctx)
        d = discount(tables[k])
        return max(tables[k].get(gram, 0) - d, 0) / total + d * kinds / total * p(gram[1:])
    return p, tables


def test_model_is_interpolated_kneser_ney(spark):
    text = "the cat sat on the mat and the rat ran to the hat that the bat had " * 3 + "zebra quilt"
    model = lang_id.train(spark.createDataFrame([(text, "en"), (None, "en"), ("x", None)], "text string, lang string"))
    assert model.langs == ["en"]

    def discount(table):
        n1, n2 = (sum(1 for n in table.values() if n == i) for i in (1, 2))
        return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5

    chars = lang_id.normalise(text).tolist()
    p, tables = kneser_ney(chars, lang_id.ORDER, discount)
    probe = lang_id.normalise("the zat thebra qqx").tolist()
    grams = [tuple(probe[i:i + lang_id.ORDER]) for i in range(len(probe) - lang_id.ORDER + 1)]
    got = lang_id.log_probs(model, np.array(grams, np.uint32))[:, 0]
    assert np.allclose(got, [math.log(p(g)) for g in grams], atol=1e-5)


def test_held_out_accuracy_on_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    rows = queries.op1_lang_id(spark, SF_ORACLE).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and 0.2 < len(held) / len(rows) < 0.3
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert np.mean([r.rejected for r in held]) < 0.01
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def model_rows(spark):
    rows = [(i, "the quick brown fox and the lazy dog of the house " * (1 + i % 5), "en", 1) for i in range(80)]
    rows += [(i, "der schnelle braune fuchs und der faule hund im haus " * (1 + i % 5), "de", 1) for i in range(80, 160)]
    rows += [(200, None, "en", 1), (201, "", "de", 1), (202, "123 !!", None, 1), (None, "the dog", None, 1),
             (203, "qxzj vkpw zzqx jjkv qwxz pvkj " * 20, None, 1), (204, "the dog of the house", None, 1),
             (204, "the dog of the house", None, 1), (205, "the house " * 60000, None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")


def test_edge_cases(spark, model_rows):
    got = {(r.doc_id): r for r in lang_id.identify(spark, model_rows).collect()}
    for i in (200, 201, 202):
        assert (got[i].lang_pred, got[i].score, got[i].nats, got[i].rejected) == ("und", 0.0, None, True)
    assert got[None].lang_pred == "en" and not got[None].held_out
    assert got[203].rejected and not got[204].rejected and got[205].lang_pred == "en"
    assert not any(r.rejected for i, r in got.items() if i is not None and i < 160)
    assert sum(r.doc_id == 204 for r in lang_id.identify(spark, model_rows).collect()) == 2


def test_nothing_to_learn(spark, model_rows):
    got = lang_id.identify(spark, model_rows.withColumn("lang", model_rows.lang.substr(9, 1)).where("doc_id = 204")
                           .selectExpr("doc_id", "text", "cast(null as string) lang")).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in got] == [("und", 0.0, True)] * 2
    assert lang_id.identify(spark, model_rows.limit(0)).count() == 0
