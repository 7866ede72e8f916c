"""Conversation repair against a plain shortest-path search."""

import hashlib
import itertools
import random
import zlib

import pytest

from conftest import SF_SMALL
from medalla.llm import conversation_repair as cr
from medalla.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
ORDER = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def cheapest(rows):
    """(cost, audit, repaired rows) by dynamic programming on whole answers."""
    def close(best):
        for _ in range(3):
            for s, (c, a, out) in list(best.items()):
                to, role = ORDER[s]
                new = (c + 5, a + "I", out + [(role, "")])
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = close({0: (0, "", [])})
    for role, text, fault in rows:
        new = {}

        def offer(s, item):
            if s not in new or item[:2] < new[s][:2]:
                new[s] = item

        for s, (c, a, out) in best.items():
            offer(s, (c + 2, a + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            kept = {"s": 1 if s == 0 else None, "u": 2 if s != 2 else None, "a": 3 if s == 2 else None}.get(role[:1])
            if kept is not None:
                offer(kept, (c + extra, a + "K", out + [(role, text)]))
            to, name = ORDER[s]
            offer(to, (c + 1 + extra, a + "R", out + [(name, text)]))
        best = close(new)
    return min((best[s] for s in (0, 3) if s in best), key=lambda x: x[:2])


def faulty(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = " " if conv is None else str(conv)
        kept = convs.setdefault(conv, [])
        k = zlib.crc32(f"{name}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        role = "user" if k == 4 else role
        kept += [(turn, role, text)] * (2 if k == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        turns = [t for t, _, _ in kept if t is not None]
        marked = faulty([(r, t) for _, r, t in kept])
        cost, audit, fixed = cheapest(marked)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(sum(f == x for _, _, f in marked) for x in ("blank", "duplicate", "truncated")),
                    sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked)),
                    cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as at", "2 as conv", "3 as fault")
    return sorted((tuple(r) for r in cr.damage_and_repair(df, **kw).collect()), key=str)


def talk(seed, convs=40, longest=12):
    r = random.Random(seed)
    return [(c, t + r.randrange(2) * 3, r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             r.choice(["a.", "b!", "c", "", " \n", "d? ", f"t{t}.", f"t{t}.", f"u{t}", None]))
            for c in range(convs) for t in range(r.randrange(1, longest))]


def test_letters_against_search():
    r = random.Random(9)
    for _ in range(400):
        codes = "".join(r.choice(r.choice(cr.CODES)) for _ in range(r.randrange(0, 9)))
        names = {"s": "system", "u": "user", "a": "assistant", "o": "other"}
        rows = [(names[i], "x", "blank" if must else "truncated" if extra else None) for i, extra, must in map(cr._read, codes)]
        state, letters = cr.trace(codes, cr._FINAL, True)[0]
        cost, audit, _ = cheapest(rows)
        assert letters == audit
        assert state in (0, 1, 2, 3)


def test_fix_equals_a_full_run():
    r = random.Random(3)
    for _ in range(300):
        codes = "".join(r.choice("suaoSUAOwxyz") for _ in range(r.randrange(1, 12)))
        old, new = (cr.backward("".join(r.choice("uaUAw") for _ in range(r.randrange(4))), cr._FINAL) for _ in range(2))
        assert cr.fix(codes, old, cr.backward(codes, old), new) == cr.backward(codes, new)


@pytest.mark.parametrize("bits,reach", [(12, 64), (1, 2)])
def test_against_brute_force(spark, bits, reach):
    rows = talk(bits)
    assert run(spark, rows, bits=bits, reach=reach) == brute(rows)


def test_long_conversation_in_many_chunks(spark):
    r = random.Random(1)
    rows = [(7, t, "user" if t % 2 == r.randrange(20) // 19 else "assistant", f"t{t}" + "." * r.randrange(2)) for t in range(600)]
    rows += [(8, t, "user", "never ends so the vectors do not meet") for t in range(300)]  # duplicates
    rows += [(9, t, "user", f"open {t}") for t in range(300)]  # all truncated: the right end reaches the left one
    rows += [(9, 400, "assistant", "done.")]
    assert run(spark, rows, bits=3, reach=3) == brute(rows)


def test_nulls_and_empty(spark):
    rows = [(None, None, None, None), (None, 2, "user", "x."), (1, None, "user", "long. " * 50_000), (1, None, "assistant", "a" * 100_000 + "."),
            (2, -5, "user", "a."), (2, 2**62, "assistant", "b."), (2, 3, "assistant", "b."), (2, 3, "assistant", "b."), (3, 0, None, "x")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows[:0]) == []


def test_repaired_rows(spark):
    rows = [("1", 0, "system", "s."), ("1", 1, "assistant", "x."), ("1", 2, "assistant", "y."), ("1", 3, "user", "z"), ("1", 4, "user", "")]
    out = cr.repair(spark.createDataFrame(rows, "conv string, turn long, role string, text string")).orderBy("seq").collect()
    assert "".join(r.edit for r in out) == cheapest(faulty([(r[2], r[3]) for r in rows]))[1]
    assert [(r.role, r.text) for r in out if r.edit != "D"] == cheapest(faulty([(r[2], r[3]) for r in rows]))[2]
    assert [r.fault for r in out if r.edit != "I"] == [None, None, None, "truncated", "blank"]


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in queries.op11_conversation_repair(spark, SF_SMALL).collect()), key=str) == brute(rows)
