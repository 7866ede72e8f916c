"""Chat formatting: round trips, masks, and the cases of the docstrings."""

import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medalla.llm import chat_format as cf

TOK = public_tokenizers.path("byte_bpe_50k.json")
PARTS = st.sampled_from([*cf.CONTROL, cf.ESCAPE, "<", "[", "|>", "/s>", "INST]", "a", " ", "\n", "ß", "漢"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    e = cf.escape(text)
    assert cf.unescape(e) == text
    assert not any(c in e for c in cf.CONTROL)


def digest(rows):
    h = hashlib.sha256()
    for role, text in rows:
        h.update(f"{role}\n{text}\n".encode())
    return h.hexdigest()


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [
        (1, 0, "user", "hi", 9), (1, 1, "assistant", "  <|end|> ok [/INST]", 9), (1, 2, "user", None, 9),
        (2, 5, "assistant", "b", 9), (2, 5, "assistant", "a", 9), (2, 5, "assistant", "a", 9),
        (None, None, None, "no id", 9), (None, 0, "assistant", "", 9), (3, 0, "assistant", "x " * 30000, 9),
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, start long")


def test_read_back(spark, conversations):
    got = {r.conv_id: r for r in cf.read_back(cf.format_conversations(conversations, TOK), TOK).collect()}
    assert len(got) == 4
    one = [("user", "hi"), ("assistant", "  <|end|> ok [/INST]"), ("user", "")]
    assert got[1].turns_sha256 == digest(one) and got[1].n_turns == 3
    assert got[1].loss_chars == len(one[1][1])
    assert got[1].loss_sha256 == hashlib.sha256(one[1][1].encode()).hexdigest()
    assert got[2].turns_sha256 == digest([("assistant", "a"), ("assistant", "a"), ("assistant", "b")])
    assert got[None].turns_sha256 == digest([("", "no id"), ("assistant", "")])
    assert got[None].loss_chars == 0
    assert got[3].loss_chars == 60000


def test_segments(spark, conversations):
    rows = cf.format_conversations(conversations, TOK).where("conv_id = 1").orderBy("seq").collect()
    assert [r.seq for r in rows] == [0, 1, 2]
    assert [r.start for r in rows] == [0, len(rows[0].ids), len(rows[0].ids) + len(rows[1].ids)]
    for r in rows:
        assert r.ids[0] == cf.TURN and r.ids[-1] == cf.END and r.ids.count(cf.TEXT) == 1
        assert len(r.ids) == len(r.mask)
    assert sum(rows[0].mask) == sum(rows[2].mask) == 0
    body = rows[1].ids[rows[1].ids.index(cf.TEXT) + 1:-1]
    assert sum(rows[1].mask) == len(body) and max(body) < cf.TURN


def test_empty(spark, conversations):
    assert cf.read_back(cf.format_conversations(conversations.limit(0), TOK), TOK).count() == 0
