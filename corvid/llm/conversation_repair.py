"""Conversation structure repair by iterative-deepening A*.

A conversation is repaired by the cheapest list of edits whose role initials read
``(s?(ua)+)?``: an optional system turn, then user and assistant in turn, or
nothing at all.  Edits, in ASCII order of their initials, with their costs:

* ``D`` delete a row (2); required for blank rows and repeats,
* ``I`` insert an empty user or assistant row (5),
* ``K`` keep a row (0),
* ``R`` give a row the role user or assistant (1).

A truncated row that is not deleted adds 5.  Of all cheapest lists the one whose
initials are least in ASCII order is the answer.

1. Rows are ordered by (conversation, turn with nulls first, role, text digest) over
   all executors and get dense positions; equal rows may take each other's place.
2. A row's first fault: blank, repeat of an earlier (role, text), or truncated.
   Repeats come from a grouped minimum over text digests, joined back on the
   unique position, so a row repeated a million times burdens no task.
3. Rows are cut into pieces of at most ``PIECE`` consecutive positions of one
   conversation.  In a piece, :class:`Search` runs depth-first in ASCII order under
   a cost bound that rises until a path is accepted.  A transposition table keeps,
   for each state that failed, the least cost that could still succeed from it; the
   root's value is the next bound.  The first accepted path is the answer.
4. A conversation of one piece is done.  For longer ones a piece is searched from
   every state it may start in to every state it may end in, and pieces are folded,
   ``FAN`` at a time and level by level, until one is left; the choice then runs
   back down.  Ties stay exact: lists of one piece are never prefixes of each other
   (each ends with a row's edit; inserts belong to the row they precede), so the
   first piece in which two lists differ decides.
5. Pieces and rows meet again in one pass sorted by position, which writes the
   repaired rows or hashes them; it holds one piece at a time, however long the
   conversation.

Defined cases: a null role or text is one space (an unknown role is reroled or
deleted); a null turn sorts first and counts in no gap; rows of a null conversation
id form one conversation; a conversation without rows, when ids are given
separately, has zeros, an empty list and the hash of an empty string; very long
texts are read by digest and once more when they are written; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import store
from corvid.operators.positions import with_positions

PIECE = 32
FAN = 32
DELETE, INSERT, RELABEL, TRUNCATED = 2, 5, 1, 5
#: states: nothing yet, after the system turn, after a user turn, after an assistant turn; DONE: accepted
EMPTY, SYSTEM, USER, ASSISTANT, DONE = range(5)
EXPECTED = {EMPTY: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
BLANK = " \t\n\x0b\x0c\r"


# --- the search in one piece -------------------------------------------------------

def kept_state(state: int, initial: str) -> int | None:
    """State after keeping a row with this role initial, or None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == EMPTY else None
    if initial == "u":
        return USER if state != USER else None
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


class Search:
    """Iterative-deepening A* over the rows of one piece.

    ``rows``: (role initial, fault number) per row.  The first guess of the cost
    still to come adds up what every row costs at least.
    """

    def __init__(self, rows: list[tuple[str, int]], last: bool):
        self.rows, self.last = rows, last
        self.least = [0] * (len(rows) + 1)
        for i in range(len(rows) - 1, -1, -1):
            self.least[i] = self.least[i + 1] + (DELETE if rows[i][1] else 0)

    def run(self, start: int, end: int) -> tuple[int, str] | None:
        """Cost and initials of the cheapest, then least, list from one state to another; None if there is none."""
        self.goal = (EMPTY, ASSISTANT) if end == DONE else (end,)
        self.failed: dict[tuple[int, int], float] = {}
        # where a list exists, deleting all rows but one and inserting two is dear enough
        bound, worst = self.least[0], DELETE * len(self.rows) + 2 * INSERT
        while bound <= worst:
            self.path: list[str] = []
            need = self._walk(0, start, bound)
            if need is None:
                return bound, "".join(self.path)
            bound = need
        return None

    def _walk(self, i: int, state: int, left: int) -> float | None:
        """None if a list within ``left`` was found (it is the path), else the least cost that may succeed."""
        if i == len(self.rows):
            if state in self.goal:
                return None
            if not self.last:            # what follows the last row belongs to the next piece
                return float("inf")
        need = self.failed.get((i, state), self.least[i])
        if need > left:
            return need
        need = float("inf")
        for initial, cost, j, then in self._edits(i, state):
            if cost <= left:
                self.path.append(initial)
                more = self._walk(j, then, left - cost)
                if more is None:
                    return None
                self.path.pop()
            else:
                more = self.failed.get((j, then), self.least[j])
            need = min(need, cost + more)
        self.failed[i, state] = need
        return need

    def _edits(self, i: int, state: int):
        """Edits in ASCII order: initial, cost, next row, next state."""
        following = EXPECTED[state][1]
        if i == len(self.rows):
            yield "I", INSERT, i, following
            return
        initial, fault = self.rows[i]
        extra = TRUNCATED if fault == 3 else 0
        yield "D", DELETE, i + 1, state
        yield "I", INSERT, i, following
        if fault in (0, 3):
            then = kept_state(state, initial)
            if then is not None:
                yield "K", extra, i + 1, then
            yield "R", RELABEL + extra, i + 1, following


@lru_cache(maxsize=1 << 14)
def solve(codes: str, first: bool, last: bool) -> tuple[tuple[int, int, int, int, str], ...]:
    """(start, end, cost, rank, initials) of a piece; ``codes`` has two characters a row: initial and fault.

    ``rank`` orders the lists of one start: the least in ASCII order has 0.
    """
    search = Search([(codes[k], int(codes[k + 1])) for k in range(0, len(codes), 2)], last)
    out = []
    for start in ((EMPTY,) if first else (EMPTY, SYSTEM, USER, ASSISTANT)):
        found = [(end, *hit) for end in ((DONE,) if last else (EMPTY, SYSTEM, USER, ASSISTANT))
                 if (hit := search.run(start, end)) is not None]
        for rank, (end, cost, audit) in enumerate(sorted(found, key=lambda x: x[2])):
            out.append((start, end, cost, rank, audit))
    return tuple(out)


# --- folding pieces -----------------------------------------------------------------

def fold(children: list[dict[tuple[int, int], tuple[int, int]]]) -> dict[tuple[int, int], tuple[int, int, list[int]]]:
    """(start, end) -> (cost, rank, states between the children) for consecutive pieces.

    Each child maps (start, end) to (cost, rank); of equal costs the first child in
    which two ways differ decides by its ranks.
    """
    by_start: dict[int, list] = {}
    for end in sorted({e for _, e in children[-1]}):
        best = {s: (c, e) for (s, e), (c, _) in children[-1].items() if e == end}
        ways = [{s: end for s in best}]
        for child in reversed(children[:-1]):
            now: dict[int, tuple] = {}
            for (s, mid), (cost, rank) in child.items():
                if mid in best and (s not in now or (cost + best[mid][0], rank) < now[s][:2]):
                    now[s] = (cost + best[mid][0], rank, mid)
            best = {s: (c, mid) for s, (c, _, mid) in now.items()}
            ways.append({s: mid for s, (_, mid) in best.items()})
        ways.reverse()
        for s, (cost, _) in best.items():
            states = [s]
            for way in ways:
                states.append(way[states[-1]])
            ranks = [child[a, b][1] for child, a, b in zip(children, states, states[1:])]
            by_start.setdefault(s, []).append((ranks, end, cost, states))
    return {(s, end): (cost, rank, states) for s, found in by_start.items()
            for rank, (_, end, cost, states) in enumerate(sorted(found))}


def _options(found) -> dict[tuple[int, int], tuple[int, int]]:
    return {(o["start"], o["end"]): (o["cost"], o["rank"]) for o in found}


_OPTIONS = "array<struct<start:int,end:int,cost:long,rank:int,audit:string>>"


def _rows_map(df: DataFrame, make, schema: T.StructType) -> DataFrame:
    """``make`` turns one row (a dict) into rows (tuples), batch by batch."""
    names = schema.names

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                out = [new for row in batch.slice(lo, 2048).to_pylist() for new in make(row)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in out], arrow.field(k).type) for k in range(len(names))], schema=arrow)

    return df.mapInArrow(run, schema)


def _chosen(pieces: DataFrame, conv: T.StructField) -> DataFrame:
    """``conv, piece, audit`` of every piece: fold upwards until conversations have one piece, then choose downwards."""
    up = T.StructType([conv, T.StructField("piece", T.LongType()),
                       T.StructField("options", T.ArrayType(T.StructType([
                           T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                           T.StructField("cost", T.LongType()), T.StructField("rank", T.IntegerType()),
                           T.StructField("audit", T.StringType())])))])
    name = conv.name
    single = pieces.filter("pieces = 1").select(name, "piece", F.col("options")[0]["audit"].alias("audit"))
    level = pieces.filter("pieces > 1").select(name, "piece", "options")
    groups: list[DataFrame] = []

    def folded(row):
        found = fold([_options(c["options"]) for c in row["children"]])
        yield row[name], row["piece"], [{"start": s, "end": e, "cost": c, "rank": r, "audit": None}
                                        for (s, e), (c, r, _) in found.items()]

    while not level.isEmpty():
        lean = level.withColumn("options", F.transform("options", lambda o: o.withField("audit", F.lit(None).cast("string"))))
        group = store(lean.groupBy(name, F.expr(f"piece div {FAN}").alias("parent"))
                      .agg(F.sort_array(F.collect_list(F.struct("piece", "options"))).alias("children"))
                      .withColumnRenamed("parent", "piece"), "repair_groups")
        groups.append(group)
        level = store(_rows_map(group, folded, up), "repair_level")
        if level.groupBy(name).count().filter("count > 1").isEmpty():
            break
    if not groups:
        return single
    # every conversation now has one piece, from EMPTY to DONE
    asked = level.select(name, "piece", F.lit(EMPTY).alias("start"), F.lit(DONE).alias("end"))
    down = T.StructType([conv, T.StructField("piece", T.LongType()), T.StructField("start", T.IntegerType()),
                         T.StructField("end", T.IntegerType())])

    def parted(row):
        kids = row["children"]
        states = fold([_options(c["options"]) for c in kids])[row["start"], row["end"]][2]
        for kid, a, b in zip(kids, states, states[1:]):
            yield row[name], kid["piece"], a, b

    def same(a: str, b: str):
        return F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}")) & (F.col("a.piece") == F.col("b.piece"))

    for group in reversed(groups):
        both = group.alias("a").join(asked.alias("b"), same("a", "b")).select("a.*", "b.start", "b.end")
        asked = store(_rows_map(both, parted, down), "repair_choice")
    many = (pieces.alias("a").join(asked.alias("b"), same("a", "b"))
            .select(f"a.{name}", "a.piece",
                    F.expr("filter(a.options, o -> o.start = b.start and o.end = b.end)[0].audit").alias("audit")))
    return single.unionByName(many)


# --- the operator -------------------------------------------------------------------

class Repair:
    """Repaired conversations of a table: :meth:`rows` and :meth:`audits` read the same stored pieces."""

    def __init__(self, df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 all_conversations: DataFrame | None = None):
        space = F.lit(" ")
        rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                         F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"))
        key = F.unhex(F.sha2("text", 256))
        self.table = with_positions(rows.withColumn("key", key), F.asc_nulls_first("conv"), F.asc_nulls_first("turn"),
                                    "role", "key", col="at")
        self.conv, self.name = self.table.schema["conv"], conv
        self.ids = all_conversations
        self.pieces = store(self._pieces(), "repair_pieces")

    def _pieces(self) -> DataFrame:
        solid = F.rtrim("text", F.lit(BLANK))
        rows = self.table.select(
            "conv", "at", "role", "key", F.substring("role", 1, 1).alias("initial"), (solid == "").alias("blank"),
            (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("truncated"))
        earliest = rows.groupBy("conv", "role", "key").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
        marked = rows.join(earliest, "at", "left")
        fault = (F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("truncated"), 3).otherwise(0))
        # a piece number is global: consecutive positions, at most PIECE of them
        coded = marked.select("conv", F.expr(f"at div {PIECE}").alias("piece"), "at",
                              F.concat(F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("-"),
                                       fault.cast("string")).alias("code"))
        pieces = (coded.groupBy("conv", "piece")
                  .agg(F.min("at").alias("at"), F.sort_array(F.collect_list(F.struct("at", "code"))).alias("held"))
                  .select("conv", "piece", "at", F.concat_ws("", F.transform("held", lambda x: x["code"])).alias("codes")))
        pieces = store(pieces, "repair_codes")
        spans = pieces.groupBy("conv").agg(F.count("*").alias("pieces"), F.min("piece").alias("lo"), F.max("piece").alias("hi"))
        known = pieces.alias("a").join(spans.alias("b"), F.col("a.conv").eqNullSafe(F.col("b.conv"))).select(
            "a.*", "b.pieces", (F.col("piece") == F.col("lo")).alias("head"), (F.col("piece") == F.col("hi")).alias("tail"))

        def solved(row):
            found = solve(row["codes"], row["head"], row["tail"])
            yield (row["conv"], row["piece"], row["at"], row["codes"], row["pieces"],
                   [dict(zip(("start", "end", "cost", "rank", "audit"), o)) for o in found])

        schema = T.StructType([self.conv, *(T.StructField(n, t) for n, t in (
            ("piece", T.LongType()), ("at", T.LongType()), ("codes", T.StringType()), ("pieces", T.LongType()))),
            T.StructField("options", T._parse_datatype_string(_OPTIONS))])
        solved_pieces = store(_rows_map(known, solved, schema), "repair_options")
        audits = _chosen(solved_pieces.select("conv", "piece", "pieces", "options"), self.conv)
        return (solved_pieces.alias("a").join(audits.alias("b"), F.col("a.conv").eqNullSafe(F.col("b.conv"))
                                              & (F.col("a.piece") == F.col("b.piece")))
                .select("a.conv", "a.at", "a.codes", "b.audit"))

    def _sorted(self) -> DataFrame:
        """Per conversation: its id, then every piece before its rows, by position."""
        nothing = F.lit(None)
        pieces = self.pieces.select("conv", "at", F.lit(1).alias("kind"), nothing.cast("long").alias("turn"),
                                    F.col("codes").alias("role"), F.col("audit").alias("text"))
        rows = self.table.select("conv", "at", F.lit(2).alias("kind"), "turn", "role", "text")
        both = pieces.unionByName(rows)
        if self.ids is not None:
            ids = self.ids.select(F.col(self.name).cast(self.conv.dataType).alias("conv")).distinct()
            both = both.unionByName(ids.select("conv", F.lit(-1).cast("long").alias("at"), F.lit(0).alias("kind"),
                                               nothing.cast("long").alias("turn"), nothing.cast("string").alias("role"),
                                               nothing.cast("string").alias("text")))
        return both.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), "at", "kind")

    def rows(self) -> DataFrame:
        """Repaired rows in order: ``<conv>, place`` (from 0), ``edit`` (I, K or R), ``turn, role, text``."""
        schema = T.StructType([T.StructField(self.name, self.conv.dataType), *(T.StructField(n, t) for n, t in (
            ("place", T.LongType()), ("edit", T.StringType()), ("turn", T.LongType()), ("role", T.StringType()),
            ("text", T.StringType())))])

        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema
            arrow, out = to_arrow_schema(schema), []
            for conv, event in _walked(batches):
                if event is None:
                    place = 0
                elif isinstance(event, _Row):
                    for edit, turn, role, text in event.lines:
                        out.append((conv, place, edit, turn, role, text))
                        place += 1
                if len(out) >= 512:
                    yield _batch(out, arrow)
                    out = []
            yield _batch(out, arrow)

        return self._sorted().mapInArrow(run, schema)

    def audits(self) -> DataFrame:
        """One row per conversation: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
        counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        schema = T.StructType([T.StructField(self.name, self.conv.dataType), *(T.StructField(n, T.LongType()) for n in counts),
                               T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema
            arrow, out, state, conv = to_arrow_schema(schema), [], None, None
            for conv, event in _walked(batches):
                if event is None:
                    if state is not None:
                        out.append(state.result())
                    state = _Audit(conv)
                    if len(out) >= 512:
                        yield _batch(out, arrow)
                        out = []
                elif isinstance(event, _Row):
                    state.row(event)
                else:
                    state.audit.append(event)
            if state is not None:
                out.append(state.result())
            yield _batch(out, arrow)

        return self._sorted().mapInArrow(run, schema)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(arrow)], schema=arrow)


class _Row:
    """A row and the lines that the repaired conversation has in its place: (edit, turn, role, text)."""

    __slots__ = ("turn", "initial", "fault", "cost", "lines")

    def __init__(self, turn, initial, fault, cost, lines):
        self.turn, self.initial, self.fault, self.cost, self.lines = turn, initial, fault, cost, lines


def _walked(batches):
    """(conversation, None) at its start, (conversation, initials) per piece, (conversation, row) per row."""
    conv, opened = None, False
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for r in batch.slice(at, 256).to_pylist():
                if not opened or r["conv"] != conv:
                    conv, opened, state = r["conv"], True, EMPTY
                    yield conv, None
                if r["kind"] == 1:
                    codes, audit, k, n = r["role"], r["text"], 0, 0
                    yield conv, audit
                elif r["kind"] == 2:
                    lines, cost = [], 0
                    while audit[k] == "I":
                        role, state = EXPECTED[state]
                        lines.append(("I", None, role, ""))
                        cost, k = cost + INSERT, k + 1
                    edit, fault = audit[k], int(codes[2 * n + 1])
                    if edit == "D":
                        cost += DELETE
                    else:
                        role = r["role"]
                        if edit == "K":
                            state = kept_state(state, codes[2 * n])
                        else:
                            role, state = EXPECTED[state]
                            cost += RELABEL
                        cost += TRUNCATED if fault == 3 else 0
                        lines.append((edit, r["turn"], role, r["text"]))
                    k, n = k + 1, n + 1
                    if 2 * n == len(codes):           # inserts after a conversation's last row
                        while k < len(audit):
                            role, state = EXPECTED[state]
                            lines.append(("I", None, role, ""))
                            cost, k = cost + INSERT, k + 1
                    yield conv, _Row(r["turn"], r["role"][:1], fault, cost, lines)


class _Audit:
    """Running figures of one conversation; texts are hashed as they pass."""

    def __init__(self, conv):
        self.conv, self.audit, self.hash, self.lines = conv, [], hashlib.sha256(), 0
        self.low = self.high = self.before = None
        self.turns = self.illegal = self.cost = 0
        self.faults = [0, 0, 0, 0]

    def row(self, r: _Row) -> None:
        if r.turn is not None:                        # rows come by turn: a new value is a new turn
            self.low = r.turn if self.low is None else self.low
            self.turns += r.turn != self.high
            self.high = r.turn
        if self.before is not None and self.before + r.initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = r.initial
        self.faults[r.fault] += 1
        self.cost += r.cost
        for _, _, role, text in r.lines:
            self.hash.update(("\n" if self.lines else "").encode() + f"{role}:{text}".encode())
            self.lines += 1

    def result(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())
