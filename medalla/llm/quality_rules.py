"""Quality rules: how much of a text lies in n-grams and lines it repeats.

Words are numbered within a block of texts; windows of n words get a rolling
polynomial hash in numpy, equal hashes are brought together by a sort and
confirmed word by word. A window of n words can only be repeated where its
shorter one is, so each length looks at what the last one left.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: words of the base rule's windows, counted with their first occurrence
BASE_WINDOW = 3
#: percentage of a text's word characters that may lie in windows of so many
#: words, or in lines, that stood earlier in it. The published
#: repetition filters of large web corpora. Their share of repeated lines by
#: number is left out: one short line of three would fail a text.
MOST_IN_NGRAMS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
MOST_IN_LINES = 20
#: the base rule: fewest words, and percentage of words in repeated windows
LEAST_WORDS, MOST_REPEATED = 50, 50
#: code points measured together (a single longer text is measured alone)
BLOCK_CHARS = 1 << 20

_SPACE = " \t\n\x0b\x0c\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "dup_line_chars", "n_repeat_words",
          *(f"dup_{n}gram_chars" for n in MOST_IN_NGRAMS)]


def _mixed(ids: np.ndarray) -> np.ndarray:
    """Numbers spread over 64 bits, so that the polynomial meets no pattern."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _FACTOR
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    return x


def repeated_windows(ids: np.ndarray, doc: np.ndarray, n: int, hashes: np.ndarray, at: np.ndarray):
    """Of the window starts ``at`` (``n`` words of one text each), those whose
    words stand at another start of the same text too, ascending in each
    group, and which of them stood earlier. ``hashes`` holds one hash per
    start in ``at``."""
    order = np.argsort(hashes, kind="stable")
    pos = at[order]
    same = np.zeros(len(pos) + 1, dtype=bool)
    same[1:-1] = hashes[order][1:] == hashes[order][:-1]
    k = np.flatnonzero(same[:-1])
    if len(k):
        a, b = pos[k], pos[k - 1]
        sure = doc[a] == doc[b]
        for j in range(n):
            sure &= ids[a + j] == ids[b + j]
        if not sure.all():  # two windows met in one hash: order by the words themselves
            order = np.lexsort((at, *(ids[at + j] for j in range(n)), doc[at]))
            pos = at[order]
            same[1:-1] = (doc[pos[1:]] == doc[pos[:-1]]) & np.logical_and.reduce(
                [ids[pos[1:] + j] == ids[pos[:-1] + j] for j in range(n)])
    later = same[:-1]
    some = later | same[1:]
    return pos[some], later[some]


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text."""
    words = [_WORD.findall(t) for t in texts]
    n_words = np.fromiter(map(len, words), dtype=np.int64, count=len(texts))
    flat = np.array([w for ws in words for w in ws], dtype=object)
    ids = pd.factorize(flat)[0].astype(np.int64) if len(flat) else np.empty(0, dtype=np.int64)
    chars = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
    doc = np.repeat(np.arange(len(texts)), n_words)

    def per_text(values: np.ndarray) -> np.ndarray:
        ends = np.concatenate(([0], np.cumsum(values)))
        edge = np.concatenate(([0], np.cumsum(n_words)))
        return ends[edge[1:]] - ends[edge[:-1]]

    def covered(starts: np.ndarray, n: int) -> np.ndarray:
        edge = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + n, -1)
        return np.cumsum(edge[:-1]) > 0

    out = {"n_words": n_words, "word_chars": per_text(chars),
           "n_symbols": np.array([len(_SYMBOL.findall(t)) for t in texts], dtype=np.int64)}
    lines = np.zeros((3, len(texts)), dtype=np.int64)
    for i, t in enumerate(texts):
        seen: set[str] = set()
        for line in t.split("\n"):
            if not line.strip(_SPACE):
                continue
            lines[0, i] += 1
            if line in seen:
                lines[1, i] += 1
                lines[2, i] += sum(map(len, _WORD.findall(line)))
            seen.add(line)
    out["n_lines"], out["n_dup_lines"], out["dup_line_chars"] = lines

    mixed, at, rolled, size = _mixed(ids), np.arange(len(ids)), np.zeros(len(ids), dtype=np.uint64), 0
    salt = _mixed(doc)
    for n in (BASE_WINDOW, *MOST_IN_NGRAMS):
        inside = at + n <= len(ids)
        at, rolled = at[inside], rolled[inside]
        inside = doc[at] == doc[at + n - 1]
        at, rolled = at[inside], rolled[inside]
        for j in range(size, n):  # roll the kept windows on to n words
            rolled = rolled * _FACTOR + mixed[at + j]
        size = n
        found, later = repeated_windows(ids, doc, n, rolled ^ salt[at], at)
        if n == BASE_WINDOW:
            out["n_repeat_words"] = per_text(covered(found, n).astype(np.int64))
        else:
            out[f"dup_{n}gram_chars"] = per_text(np.where(covered(found[later], n), chars, 0))
        keep = np.isin(at, found, assume_unique=True)
        at, rolled = at[keep], rolled[keep]
    return out


def _blocks(texts: list[str]) -> Iterator[list[str]]:
    block: list[str] = []
    size = 0
    for t in texts:
        if block and size + len(t) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        block.append(t)
        size += len(t)
    if block:
        yield block


@F.pandas_udf(StructType([StructField(c, LongType()) for c in COUNTS]))
def _counts(text: pd.Series) -> pd.DataFrame:
    parts = [pd.DataFrame(measure(b)) for b in _blocks([t or "" for t in text])]
    return pd.concat(parts, ignore_index=True)[COUNTS] if parts else pd.DataFrame(columns=COUNTS)


def quality(docs: DataFrame) -> DataFrame:
    """``docs(text, ...)`` with ``COUNTS``, ``base_failed`` and ``kept``.

    Words are runs without ASCII white space. ``word_chars`` counts their code
    points, ``n_symbols`` the characters ``#*$%&|<>``, ``n_lines`` the
    newline-split lines that hold a word, ``n_dup_lines`` those of them equal
    to an earlier one and ``dup_line_chars`` the code points of their words,
    ``n_repeat_words`` the words in three-word windows that stand twice or
    more in the text (the first included), ``dup_<n>gram_chars`` the code
    points of words in windows of n words that stood earlier in the text,
    overlaps counted once. ``base_failed``: under LEAST_WORDS words, or more
    than MOST_REPEATED per cent of the words repeat. ``kept``: neither that
    nor above a limit of ``MOST_IN_NGRAMS`` or ``MOST_IN_LINES``.

    A narrow pass: nothing is shuffled and only ``text`` goes to Python, in
    blocks of BLOCK_CHARS code points. Null text has no words and fails as an
    empty one does. Repeated rows, null ids and other columns stay as they
    are; columns of the result's names are replaced. An empty table gives an
    empty result.
    """
    names = [*COUNTS, "base_failed", "kept"]
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    got = "quality counts"  # one nested column, split below
    while got in docs.columns:
        got += "_"
    rows = docs.select(*rest, _counts(F.col("text").cast("string")).alias(got)).select(*rest, f"`{got}`.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    bad = failed | (100 * F.col("dup_line_chars") > MOST_IN_LINES * F.col("word_chars"))
    for n, most in MOST_IN_NGRAMS.items():
        bad = bad | (100 * F.col(f"dup_{n}gram_chars") > most * F.col("word_chars"))
    return rows.withColumns({"base_failed": failed, "kept": ~bad})
