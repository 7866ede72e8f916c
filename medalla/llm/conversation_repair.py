"""Conversation structure repair by a rank-convergence parallel Viterbi.

The cheapest edits that make the roles of a conversation read ``(s?(ua)+)?``
are a shortest path over four states (nothing yet, after a system, a user, an
assistant turn). A conversation is cut into chunks of rows. Every chunk runs
backwards from a speculative vector of costs; fix-up passes rerun a chunk from
its right neighbour's vector until, at some row, the new vector differs from
the old one by a constant only: what lies further left then differs by the
same constant and stands. With each chunk's right vector settled, chunks trace
their cheapest edits forwards from every state, and the chunks' exits are
stitched in order.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medalla.llm.common import stage
from medalla.session import shuffle_partitions

#: rows of a range partition that make a chunk, as a power of two
CHUNK_BITS = 12
#: chunks that a fix-up pass walks through in a row; squared, cubed, ... in
#: later passes, so that their number is a logarithm of the chunks
REACH = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs
#: a row's code: role initial s, u, a or other, in lower case; upper case if
#: truncated; of the third set if it must go (blank, duplicate)
CODES = ("suao", "SUAO", "wxyz")
_SPACE = " \t\n\u000b\f\r"
_FINAL = (0, 2 * INSERT, INSERT, 0)  # cost from each state at the end
_NEXT = (2, 2, 3, 2)  # the turn a state asks for: user, or assistant after a user
_ROLE = {2: "user", 3: "assistant"}


def _keep(state: int, initial: str) -> int | None:
    """The state after a kept row, or None where the grammar forbids it."""
    if initial == "s":
        return 1 if state == 0 else None
    if initial == "u":
        return 2 if state != 2 else None
    return 3 if initial == "a" and state == 2 else None


def _read(code: str) -> tuple[str, int, bool]:
    """Initial, cost of leaving the row in, whether it must go."""
    kind = next(i for i, s in enumerate(CODES) if code in s)
    return CODES[0][CODES[kind].index(code)], TRUNCATED if kind == 1 else 0, kind == 2


def _options(after: tuple, code: str, state: int) -> Iterator[tuple[int, str, int]]:
    """``(cost to the end, letter, next state)`` of the edits of a row."""
    initial, extra, forced = _read(code)
    yield DELETE + after[state], "D", state
    if not forced:
        kept = _keep(state, initial)
        if kept is not None:
            yield KEEP + extra + after[kept], "K", kept
        yield REROLE + extra + after[_NEXT[state]], "R", _NEXT[state]


@functools.cache
def _costs(after: tuple, code: str) -> tuple:
    """Cost vector before a row from the one behind it."""
    row = [min(o[0] for o in _options(after, code, s)) for s in range(4)]
    user, assistant = min(row[2], INSERT + row[3]), min(row[3], INSERT + row[2])
    return min(row[0], INSERT + user), min(row[1], INSERT + user), user, assistant


@functools.cache
def before(after: tuple, code: str) -> tuple:
    """``_costs`` less their smallest, so that vectors that differ by a
    constant are equal; there are few, so each step is computed once."""
    v = _costs(after, code)
    return tuple(x - min(v) for x in v)


@functools.cache
def _step(after: tuple, code: str, state: int) -> tuple[str, int]:
    """The ASCII-least letters among the cheapest edits up to and with a row,
    and the state behind it."""
    here, letters = _costs(after, code), ""
    while True:
        found = [o for o in _options(after, code, state) if o[0] == here[state]]
        least = min(found, key=lambda o: o[1], default=None)
        insert = INSERT + here[_NEXT[state]] == here[state]
        if least and (least[1] < "I" or not insert):
            return letters + least[1], least[2]
        letters, state = letters + "I", _NEXT[state]


def backward(codes: str, right: tuple) -> tuple:
    """The vector before a chunk."""
    for c in reversed(codes):
        right = before(right, c)
    return right


def fix(codes: str, old: tuple, start: tuple, new: tuple) -> tuple:
    """The vector before a chunk from ``new`` behind it, ``start`` being the
    one from ``old``; stops where the two differ by a constant."""
    for c in reversed(codes):
        if new == old:
            return start
        old, new = before(old, c), before(new, c)
    return start if new == old else new


def trace(codes: str, right: tuple, last: bool) -> list[tuple[int, str]]:
    """For each state before a chunk: the state behind it and the letters of
    the least cheapest edits; the ``last`` one also closes the conversation."""
    vectors = [right]
    for c in reversed(codes):
        vectors.append(before(vectors[-1], c))
    vectors.reverse()
    out = []
    for state in range(4):
        letters = []
        for i, c in enumerate(codes):
            s, state = _step(vectors[i + 1], c, state)
            letters.append(s)
        if last:
            letters.append("I" * {0: 0, 1: 2, 2: 1, 3: 0}[state])
        out.append((state, "".join(letters)))
    return out


def damage(rows: DataFrame) -> DataFrame:
    """``(conv, turn, role, text)`` of ``rows(conv_id, turn, role, text)``
    with a fifth of the rows damaged by crc32(``conv_id:turn``) % 20; ``conv``
    is the id as text, one space for null, as are null roles and texts."""
    space = F.lit(" ")
    t = rows.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), space).alias("conv"),
                    F.col("turn").cast("long").alias("turn"),
                    F.coalesce(F.col("role").cast("string"), space).alias("role"),
                    F.coalesce(F.col("text").cast("string"), space).alias("text"))
    fault = F.crc32(F.concat("conv", F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    t = t.withColumn("fault", fault).where("fault <> 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(
        F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return t.select("conv", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def ordered(rows: DataFrame) -> DataFrame:
    """``rows(conv, turn, role, text)`` with ``at``, ascending in the order of
    conversation, turn (null first), role, text, written once. Rows are
    range-partitioned, so a conversation may lie in many partitions."""
    n = shuffle_partitions(rows.sparkSession)
    turn = F.col("turn").asc_nulls_first()
    # equal starts of texts stay together, so the sampled keys are short
    parts = rows.repartitionByRange(n, "conv", turn, "role", F.substring("text", 1, 32))
    return stage(parts.sortWithinPartitions("conv", turn, "role", "text")
                 .withColumn("at", F.monotonically_increasing_id()), "repair-rows")


def coded(rows: DataFrame) -> DataFrame:
    """``(conv, at, code)`` of ``ordered`` rows. Blank rows and duplicates
    (role and text seen earlier) must go; others may be truncated."""
    end = F.rtrim(F.col("text"), F.lit(_SPACE))
    slim = stage(rows.select("conv", "at", F.substring("role", 1, 1).alias("initial"), (end == "").alias("blank"),
                             (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("open"),
                             F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("same")),
                 "repair-faults")
    first = slim.groupBy("conv", "same").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    kind = F.when(F.col("blank") | F.col("first").isNull(), 3).when(F.col("open"), 2).otherwise(1)
    which = F.when(F.col("initial").isin("s", "u", "a"), F.instr(F.lit(CODES[0]), F.col("initial"))).otherwise(4)
    return slim.join(first, "at", "left").select(
        "conv", "at", F.substring(F.element_at(F.array(*map(F.lit, CODES)), kind), which, F.lit(1)).alias("code"))


def _vector(name: str) -> str:
    return f"{name} array<int>"


def settle(chunks: DataFrame, reach: int = REACH) -> DataFrame:
    """``chunks(conv, k, codes, last)`` (k counts a conversation's chunks from
    0) with ``right``, the vector behind each up to a constant."""
    fields = f"conv string, k long, codes string, last boolean, at long, {_vector('right')}, {_vector('start')}"
    names = ["conv", "k", "codes", "last", "at", "right", "start"]

    def speculate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(right=[_FINAL] * len(b), start=[backward(c, _FINAL) for c in b.codes])[names]

    state = stage(chunks.mapInPandas(speculate, fields), "repair-chunks")
    size = 1
    while True:
        behind = state.select("conv", (F.col("k") - 1).alias("k"), F.col("start").alias("behind"))
        both = state.join(behind, ["conv", "k"], "left")
        if not both.where(F.col("behind").isNotNull() & (F.col("behind") != F.col("right"))).limit(1).count():
            return state
        size *= reach
        run = F.floor(F.col("k") / size)

        def rerun(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held, carry = None, None
            for b in batches:
                rights, starts = [], []
                for conv, r, codes, right, start, behind in zip(b.conv, b.run, b.codes, b.right, b.start, b.behind):
                    right, start = tuple(right), tuple(start)
                    # within a run of chunks the vector just made, else the neighbour's of the last pass
                    new = carry if held == (conv, r) else right if behind is None else tuple(behind)
                    start = fix(codes, right, start, new)
                    held, carry = (conv, r), start
                    rights.append(new), starts.append(start)
                yield b.assign(right=rights, start=starts)[names]

        rows = both.withColumn("run", run).repartition("conv", "run").sortWithinPartitions("conv", "run", F.desc("k"))
        state = stage(rows.mapInPandas(rerun, fields), "repair-chunks")


def edits(codes: DataFrame, bits: int = CHUNK_BITS, reach: int = REACH) -> DataFrame:
    """``(conv, at, codes, state, letters)`` per chunk of ``codes(conv, at,
    code)``: its first row, its rows' codes, the state before it and the
    letters of its edits, K keep, R rerole, D delete, I insert, each row's
    after the inserts before it."""
    chunk = codes.groupBy("conv", F.shiftright("at", bits).alias("chunk")).agg(
        F.min("at").alias("at"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "code"))), lambda x: x["code"]),
                                              "").alias("codes"))
    chunk = stage(chunk, "repair-codes")
    # one record per chunk and no codes: a conversation's are numbered in one task
    w = Window.partitionBy("conv").orderBy("at")
    number = chunk.select("conv", "at", (F.row_number().over(w) - 1).cast("long").alias("k"),
                          F.lead("at").over(w).isNull().alias("last"))
    chunk = chunk.join(number, ["conv", "at"]).select("conv", "k", "codes", "last", "at")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ways = [trace(c, tuple(r), e) for c, r, e in zip(b.codes, b.right, b["last"])]
            yield pd.DataFrame({"conv": b.conv, "k": b.k, "at": b["at"], "codes": b.codes, "exits": [[w[0] for w in x] for x in ways],
                                "ways": [[w[1] for w in x] for x in ways]})

    traced = stage(settle(chunk, reach).mapInPandas(walk, "conv string, k long, at long, codes string, exits array<int>, "
                                                        "ways array<string>"),
                   "repair-traces")

    def stitch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, state = None, 0
        for b in batches:
            states = []
            for conv, exits in zip(b.conv, b.exits):
                state = 0 if conv != held else state
                states.append(state)
                held, state = conv, int(exits[state])
            yield pd.DataFrame({"at": b["at"], "state": states})

    entry = traced.select("conv", "k", "at", "exits").repartition("conv").sortWithinPartitions("conv", "k").mapInPandas(
        stitch, "at long, state int")
    return traced.join(entry, "at").select("conv", "at", "codes", "state", F.col("ways")[F.col("state")].alias("letters"))


def repair(rows: DataFrame, bits: int = CHUNK_BITS, reach: int = REACH) -> DataFrame:
    """The edits of all conversations of ``rows(conv, turn, role, text)``.

    Returns ``conv, seq`` (place among the conversation's edits), ``edit`` (K
    keep, R rerole, D delete, I insert), ``turn, was`` (the role before; null
    for an insert), ``role, text`` (as repaired) and ``fault`` (blank,
    duplicate, truncated or null). The repaired conversation is what is not
    deleted, by ``seq``.

    Rows of a conversation count in the order of turn (null first), then role,
    then text, so ties and repeated rows have one order. Null roles and texts
    must have been filled; other columns are ignored. An empty table gives an
    empty result. A conversation may hold any number of rows: they are coded
    in range partitions and solved in chunks of 2 ** ``bits`` rows; only the
    last pass, which writes its text in order, streams it through one task,
    one row at a time. Each partition of the result holds whole
    conversations in the order of ``seq``.
    """
    rows = ordered(rows)
    plan = edits(coded(rows), bits, reach)

    def none(kind: str, name: str):
        return F.lit(None).cast(kind).alias(name)

    # a chunk's plan goes before its first row; turns travel as text: a null would make them floats
    body = rows.select("conv", "at", F.lit(1).alias("kind"), F.col("turn").cast("string").alias("turn"), "role", "text",
                       none("string", "codes"), none("int", "state"))
    head = plan.select("conv", "at", F.lit(0).alias("kind"), none("string", "turn"), none("string", "role"),
                       F.col("letters").alias("text"), "codes", "state")
    both = body.unionByName(head).repartition("conv").sortWithinPartitions("conv", "at", "kind")

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, seq, state, letters, at, codes, row = None, 0, 0, "", 0, "", 0
        out: list[tuple] = []

        def insert() -> None:
            nonlocal seq, state, at
            while letters[at:at + 1] == "I":
                state = _NEXT[state]
                out.append((held, seq, "I", None, None, _ROLE[state], "", None))
                seq, at = seq + 1, at + 1

        for b in batches:
            for conv, kind, turn, role, text, known, entry in zip(b.conv, b.kind, b.turn, b.role, b.text, b.codes, b.state):
                if conv != held:
                    held, seq = conv, 0
                if not kind:
                    state, letters, at, codes, row = int(entry), text, 0, known, 0
                    insert()
                    continue
                letter, new = letters[at], role
                if letter == "K":
                    state = _keep(state, role[:1])
                elif letter == "R":
                    state = _NEXT[state]
                    new = _ROLE[state]
                fault = None if codes[row] in CODES[0] else "truncated" if codes[row] in CODES[1] else (
                    "duplicate" if text.strip(_SPACE) else "blank")
                out.append((conv, seq, letter, None if turn is None else int(turn), role, new, text, fault))
                seq, at, row = seq + 1, at + 1, row + 1
                insert()
            if out:
                yield pd.DataFrame(out, columns=names).astype({"turn": "Int64"})
                out.clear()

    names = ["conv", "seq", "edit", "turn", "was", "role", "text", "fault"]
    return both.mapInPandas(apply, "conv string, seq long, edit string, turn long, was string, role string, text string, fault string")


def report(repaired: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per ``convs(conv)`` from ``repair``'s result, read where it was
    made: ``conv_id, gaps`` (turn numbers missing between the smallest and the
    largest), ``blank, duplicate, truncated`` (rows by fault), ``illegal``
    (neighbours whose role initials are not su, ua or au), ``cost, audit`` (the
    edits' letters), ``repaired_sha256`` (``role:text`` joined by newlines). A
    conversation without rows has zeros and the digest of nothing. Holds one
    row, a running digest and the letters of one conversation at a time."""
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    price = {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = s = None

        def row():
            gaps = s["high"] - s["low"] + 1 - s["turns"] if s["turns"] else 0
            return (held, gaps, s["blank"], s["duplicate"], s["truncated"], s["illegal"], s["cost"], "".join(s["audit"]),
                    s["sha"].hexdigest())

        for b in batches:
            out = []
            for conv, edit, turn, was, role, text, fault in zip(b.conv, b.edit, b.turn, b.was, b.role, b.text, b.fault):
                if conv != held:
                    if s:
                        out.append(row())
                    held = conv
                    s = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": [], "turns": 0,
                         "low": None, "high": None, "initial": None, "sha": hashlib.sha256(), "join": ""}
                if edit != "I":
                    turn = None if turn is None else int(turn)
                    if turn is not None and turn != s["high"]:
                        s["low"], s["high"], s["turns"] = turn if s["low"] is None else s["low"], turn, s["turns"] + 1
                    if s["initial"] is not None and s["initial"] + was[:1] not in ("su", "ua", "au"):
                        s["illegal"] += 1
                    s["initial"] = was[:1]
                    if fault:
                        s[fault] += 1
                s["audit"].append(edit)
                s["cost"] += price[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
                if edit != "D":
                    s["sha"].update(f"{s['join']}{role}:{text}".encode())
                    s["join"] = "\n"
            if out:
                yield pd.DataFrame(out, columns=names)
        if s:
            yield pd.DataFrame([row()], columns=names)

    counts = names[1:7]
    got = repaired.withColumn("turn", F.col("turn").cast("string")).mapInPandas(digest, "conv string, " + ", ".join(f"{c} long" for c in counts) + ", audit string, repaired_sha256 string")
    return convs.join(got, "conv", "left").select(
        F.nullif("conv", F.lit(" ")).cast("long").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def damage_and_repair(rows: DataFrame, bits: int = CHUNK_BITS, reach: int = REACH) -> DataFrame:
    """``report`` on ``rows(conv_id, turn, role, text)`` after ``damage``, one
    row per conv_id of the table, null included (rows without an id are one
    conversation). An empty table gives an empty result."""
    convs = rows.select(F.coalesce(F.col("conv_id").cast("long").cast("string"), F.lit(" ")).alias("conv")).distinct()
    return report(repair(damage(rows), bits, reach), convs)
