"""Conversation repair: equal to a plain search over all edit lists; pieces, long conversations, defined cases."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from llm_fixtures import package  # noqa: F401
from pyspark.sql import functions as F

from corvid.llm import conversation_repair as R
from corvid.llm.common import table
from corvid.llm.q_conversations import damaged, op13_conversation_repair

SCHEMA = "conv_id long, turn long, role string, text string"
OK = re.compile(r"(s?(ua)+)?")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        out.append(1 if not solid else 2 if (role, text) in seen else 3 if solid[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def cheapest(rows):
    """Dynamic program over (row, state) that keeps the least (cost, initials): the tie rule read backwards is exact."""
    marks = faults(rows)

    def kept(state, c):
        return {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, c))

    nxt = {0: 2, 1: 2, 2: 3, 3: 2}
    n = len(rows)
    best = [[None] * 4 for _ in range(n + 1)]
    for i in range(n, -1, -1):
        base = []
        for s in range(4):
            found = [(0, "")] if i == n and s in (0, 3) else []
            if i < n:
                f, extra = marks[i], 5 if marks[i] == 3 else 0
                moves = [("D", 2, s)]
                if f in (0, 3):
                    if kept(s, rows[i][0][:1]) is not None:
                        moves.append(("K", extra, kept(s, rows[i][0][:1])))
                    moves.append(("R", 1 + extra, nxt[s]))
                for e, c, t in moves:
                    if best[i + 1][t]:
                        found.append((best[i + 1][t][0] + c, e + best[i + 1][t][1]))
            base.append(found)
        now = [min(f) if f else None for f in base]
        for _ in range(3):                            # inserts: shortest ways round the states
            now = [min([*base[s], *([(now[nxt[s]][0] + 5, "I" + now[nxt[s]][1])] if now[nxt[s]] else [])], default=None)
                   for s in range(4)]
        best[i] = now
    return best[0][0]


def by_enumeration(rows, most):
    """All lists up to a cost, without any state machine but the pattern itself."""
    marks, found = faults(rows), []

    def go(i, cost, audit, initials):
        if cost > most:
            return
        if i == len(rows) and OK.fullmatch(initials):
            found.append((cost, audit))
        if i < len(rows):
            go(i + 1, cost + 2, audit + "D", initials)
            if marks[i] in (0, 3):
                extra = 5 if marks[i] == 3 else 0
                go(i + 1, cost + extra, audit + "K", initials + rows[i][0][:1])
                for c in "ua":
                    go(i + 1, cost + extra + 1, audit + "R", initials + c)
        for c in "ua":
            go(i, cost + 5, audit + "I", initials + c)

    go(0, 0, "", "")
    return min(found)


def repaired(rows, audit):
    out, i, state = [], 0, 0
    step = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    for e in audit:
        if e == "I":
            role, state = step[state]
            out.append(f"{role}:")
            continue
        role, text = rows[i]
        i += 1
        if e == "K":
            state = {"s": 1, "u": 2, "a": 3}[role[0]]
        elif e == "R":
            role, state = step[state]
        if e != "D":
            out.append(f"{role}:{text}")
    return hashlib.sha256("\n".join(out).encode()).hexdigest()


def expected(conversations):
    """conversations: id -> list of (turn, role, text) as in the table; damage, faults, repair in plain Python."""
    out = {}
    for conv, rows in conversations.items():
        kept = []
        for turn, role, text in rows:
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            role = "user" if kind == 4 else role
            kept += [(turn, role, text)] * (2 if kind == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        rows = [(role, text) for _, role, text in kept]
        turns = [t for t, _, _ in kept if t is not None]
        marks = faults(rows)
        cost, audit = cheapest(rows)
        bad = sum((a[:1] + b[:1]) not in ("su", "ua", "au") for (a, _), (b, _) in itertools.pairwise(rows))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, marks.count(1), marks.count(2), marks.count(3), bad, cost, audit, repaired(rows, audit))
    return out


def random_rows(rng, n):
    return [(rng.choice(["user", "assistant", "user", "assistant", "system", "tool"]),
             rng.choice(["", " \t", "a.", "b!", f"x{rng.random()}.", f"y{rng.random()}", "cut"])) for _ in range(n)]


def test_plain_searches_agree():
    rng = random.Random(5)
    for _ in range(60):
        rows = random_rows(rng, rng.randint(0, 4))
        best = cheapest(rows)
        assert by_enumeration(rows, best[0]) == best


def test_a_piece_equals_the_dynamic_program():
    rng = random.Random(6)
    for _ in range(400):
        rows = random_rows(rng, rng.randint(1, 12))
        codes = "".join((r[0] if r[0] in "sua" else "-") + str(f) for (r, _), f in zip(rows, faults(rows)))
        (found,) = R.solve(codes, True, True)
        assert (found[2], found[4]) == cheapest(rows)


@pytest.mark.parametrize("cut", [1, 2, 3, 7])
def test_folded_pieces_equal_the_dynamic_program(cut):
    rng = random.Random(7 + cut)
    for _ in range(150):
        rows = random_rows(rng, rng.randint(2, 14))
        codes = [(r[0] if r[0] in "sua" else "-") + str(f) for (r, _), f in zip(rows, faults(rows))]
        parts = ["".join(codes[i:i + cut]) for i in range(0, len(codes), cut)]
        solved = [R.solve(p, i == 0, i == len(parts) - 1) for i, p in enumerate(parts)]
        cost, _, states = R.fold([{(s, e): (c, r) for s, e, c, r, _ in p} for p in solved])[R.EMPTY, R.DONE]
        audit = "".join(next(a for s, e, _, _, a in p if (s, e) == way) for p, way in zip(solved, itertools.pairwise(states)))
        assert (cost, audit) == cheapest(rows)


def grouped(rows):
    out = {}
    for conv, *rest in rows:
        out.setdefault(conv, []).append(tuple(rest))
    return out


def test_query_equals_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in op13_conversation_repair(spark, sf).collect()}
    assert got == expected(grouped(rows))


def test_defined_cases_and_a_conversation_of_many_pieces(spark):
    rng = random.Random(9)
    rows = [(None, None, None, None), (None, 1, "user", "a."), (1, None, "system", "s."), (1, None, "user", None),
            (2, 5, "user", "same."), (2, 5, "user", "same."), (2, 5, "user", "same."), (3, 1, "user", "long " * 100_000),
            (4, 0, None, "x."), (4, 7, "assistant", "\n")]
    dropped = next(t for t in range(1000) if zlib.crc32(f"6:{t}".encode()) % 20 == 0)
    rows.append((6, dropped, "user", "gone."))
    rows += [(5, i, *r) for i, r in enumerate(random_rows(rng, 5000))]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.lit(1)).withColumn("piece", F.lit(2)).repartition(5)
    got = {r[0]: tuple(r)[1:] for r in R.Repair(damaged(df), all_conversations=df.select("conv_id")).audits().collect()}
    assert got == expected(grouped(rows))
    assert got[6] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_rows_alternate_and_an_empty_table(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "assistant", "b."), (1, 2, "user", "c."), (2, 0, "tool", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in R.Repair(df).rows().orderBy("conv_id", "place").collect()]
    cost, audit = cheapest([(r, t) for _, _, r, t in rows[:3]])
    assert audit == "RKD" and cost == 3
    assert got == [(1, 0, "R", 0, "user", "a."), (1, 1, "K", 1, "assistant", "b.")]
    assert R.Repair(df.limit(0)).audits().count() == 0
