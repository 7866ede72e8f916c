"""Chat formatting by token-level assembly.

Every segment (a role, a text) is encoded on its own by a public byte-level
BPE, so no merge crosses a boundary; turns are marked by reserved ids beyond
the vocabulary, spliced in between. Control strings that occur inside the
content are escaped reversibly first, so that a template rendered to text is
as unambiguous as the ids. The loss mask comes from prefix sums over the
assembled ids: +1 where an assistant text starts, -1 where it ends.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Reserved ids: the first free ones beyond the 50,257 of the vocabulary.
TURN, TEXT, END = 50257, 50258, 50259
#: how the reserved ids are written when a conversation is rendered as text
MARKS = {TURN: "<|turn|>", TEXT: "<|text|>", END: "<|end|>"}
#: strings with a meaning to this or another common template; each starts
#: with one character found nowhere else in it, where the escape goes
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<|turn|>", "<|text|>", "<|end|>", "<|im_start|>", "<|im_end|>",
           "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<|eot_id|>", "<|begin_of_text|>",
           "<|start_header_id|>", "<|end_header_id|>")
ESCAPE = "\u2060"  # WORD JOINER
_BODY = "|".join(regex.escape(c[1:]) for c in CONTROL if c[0] == "<")
_SQUARE = "|".join(regex.escape(c[1:]) for c in CONTROL if c[0] == "[")
#: (opening)(escapes already there)(rest of a control string)
PATTERN = rf"(?:(<)({ESCAPE}*)({_BODY})|(\[)({ESCAPE}*)({_SQUARE}))"
_FIND = regex.compile(PATTERN)


def escape(text: str) -> str:
    """One more escape character after the opening of each control string,
    counting those that already hold escape characters; ``unescape`` takes
    one away, so that any text whatever comes back."""
    return _FIND.sub(lambda m: (m[1] or m[4]) + (m[2] or m[5] or "") + ESCAPE + (m[3] or m[6]), text)


def unescape(text: str) -> str:
    return _FIND.sub(lambda m: (m[1] or m[4]) + (m[2] or m[5] or "")[:-1] + (m[3] or m[6]), text)


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings are ordinary text here
    return t


def format_conversations(rows: DataFrame, tokenizer_path: str) -> DataFrame:
    """The turns of ``rows(conv_id, turn, role, text)`` as token segments.

    Returns one row per turn: ``conv_id, seq`` (place in the conversation,
    from 0), ``ids`` (reserved and ordinary ids of the turn), ``mask`` (as
    many 0/1: 1 on the tokens of an assistant's text) and ``start`` (ids of
    the conversation before this turn, a running sum), so the whole is the
    concatenation by ``seq`` however long a conversation is.

    Turns are ordered by turn, then role, then text, so ties and repeated
    rows have one order; a null turn comes first. Null text or role is the
    empty string; a null conv_id is a conversation of its own. Other columns
    are ignored; an empty table gives an empty result. Conversations are
    hash-partitioned and sorted on disk; a partition is streamed, so a
    conversation with a third of all rows needs no more memory than others.
    """
    t = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    t = t.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, last, seq, start = _tokenizer(tokenizer_path), object(), 0, 0
        for b in batches:
            texts = [escape(x) for x in b.text]
            enc = tok.encode_batch(texts, add_special_tokens=False)
            roles = tok.encode_batch([escape(x) for x in b.role], add_special_tokens=False)
            seqs, ids, masks, starts = [], [], [], []
            for conv, role, r, e in zip(b.conv_id, b.role, roles, enc):
                conv = None if pd.isna(conv) else conv
                if conv != last:
                    last, seq, start = conv, 0, 0
                flat = np.array([TURN, *r.ids, TEXT, *e.ids, END], dtype=np.int32)
                edge = np.zeros(len(flat) + 1, dtype=np.int8)
                if role == "assistant":
                    edge[len(r.ids) + 2] += 1
                    edge[len(flat) - 1] -= 1
                seqs.append(seq), ids.append(flat), starts.append(start)
                masks.append(np.cumsum(edge[:-1], dtype=np.int8))
                seq, start = seq + 1, start + len(flat)
            yield pd.DataFrame({"conv_id": b.conv_id.astype("Int64"), "seq": seqs, "ids": ids, "mask": masks,
                                "start": starts})

    return t.mapInPandas(assemble, "conv_id long, seq long, ids array<int>, mask array<tinyint>, start long")


def read_back(segments: DataFrame, tokenizer_path: str) -> DataFrame:
    """Digests of each conversation, read from its ids and mask alone.

    One row per conversation: ``conv_id, n_turns, turns_sha256`` (role,
    newline, text, newline for each turn, unescaped), ``loss_chars,
    loss_sha256`` (all text under the mask, unescaped) and
    ``formatted_chars`` (code points with the marks written out). Streams
    each partition sorted by conversation; holds one turn and two running
    hashes at a time.
    """
    s = segments.select("conv_id", "seq", "ids", "mask").repartition("conv_id").sortWithinPartitions("conv_id", "seq")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok, last, state = _tokenizer(tokenizer_path), object(), None
        text = functools.partial(tok.decode, skip_special_tokens=False)

        def row():
            return (last, state["n"], state["turns"].hexdigest(), state["chars"], state["loss"].hexdigest(),
                    state["all"])

        for b in batches:
            out = []
            for conv, ids, mask in zip(b.conv_id, b.ids, b["mask"]):
                conv = None if pd.isna(conv) else int(conv)
                if conv != last:
                    if state:
                        out.append(row())
                    last = conv
                    state = {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0}
                ids, mask = np.asarray(ids), np.asarray(mask, dtype=bool)
                mid = int(np.flatnonzero(ids == TEXT)[0])
                role, body = text(ids[1:mid].tolist()), text(ids[mid + 1:-1].tolist())
                state["n"] += 1
                state["all"] += len(role) + len(body) + sum(len(MARKS[x]) for x in (TURN, TEXT, END))
                state["turns"].update(f"{unescape(role)}\n{unescape(body)}\n".encode())
                if mask.any():
                    learnt = unescape(text(ids[mask].tolist()))
                    state["chars"] += len(learnt)
                    state["loss"].update(learnt.encode())
            if out:
                yield pd.DataFrame(out, columns=names)
        if state:
            yield pd.DataFrame([row()], columns=names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return s.mapInPandas(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                 "loss_sha256 string, formatted_chars long")
