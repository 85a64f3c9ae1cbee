"""Best-fit packing of token pieces by a configuration linear program.

Tokenizing runs in Arrow batches; each task numbers its pieces per length, so
a piece's rank among all pieces of its length is an offset per (task, length)
plus that number: no sort and no window over a hot length.  Only the length
histogram (at most ``capacity`` rows) reaches the driver.  There the
configuration LP (cover every length class with as few filled sequences as
possible) is solved by multiplicative weights; a knapsack dynamic program
prices the best configuration per round.  It is rounded in two ways, and the
plan with fewer sequences is taken:

* the fractional solution is rounded down and split into exact lengths, its
  smallest piece chosen anew best-fit along with whatever else fits the exact
  room (with short pieces kept back as filling, without, and with fine steps);
* the averaged weights are the pieces' prices, and the knapsack program prices
  one configuration after the other for what is left, the fullest of the best.

The plan is a bounded table of slot runs (length, ranks, sequence, offset);
tasks look their pieces up in it.

Defined cases: a null or empty text is the single end id; repeated rows are
packed each on their own; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corvid.llm.common import store

CAPACITY = 4096
END_ID = 1
CLASSES = 256           # the LP sees lengths in so many classes of equal width
ROUNDS = 1500
MEMO_WORDS = 400_000    # per Python worker, and as many old ones


# --- tokenizing ---------------------------------------------------------------

def _byte_chars() -> list[str]:
    """Byte -> character of a byte-level vocabulary: printable bytes are themselves, others follow 255."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class WordIds(dict):
    """Chunk of text without blanks -> its ids as little-endian uint32 bytes.

    White space separates words for this tokenizer and is dropped, so a text's
    ids are those of its blank-free chunks in turn, and each distinct chunk is
    encoded once per worker (at ``MEMO_WORDS`` entries the table becomes the old
    one, from which what is still in use is taken over).  Chunks of printable
    ASCII and letters of Latin-1, the usual case, are split here as the tokenizer
    splits them, and each piece goes to the BPE model once; all else takes the
    whole tokenizer.
    """

    PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
    PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-zà-öø-ÿß0-9]+")     # of lower-cased chunks

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.old: dict[str, bytes] = {}
        self.chars = _byte_chars()

    def piece(self, s: str) -> bytes:
        word = s if s.isascii() else "".join(map(self.chars.__getitem__, s.encode()))
        return _uint32([t.id for t in self.model.tokenize(word)])

    def __missing__(self, chunk: str) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            if chunk.isascii() and chunk.isalpha():
                pieces = [chunk.lower()]
            elif self.PLAIN.fullmatch(chunk):
                pieces = self.PIECE.findall(chunk.lower())
            else:
                pieces = []
            if not pieces:
                found = _uint32(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
            elif pieces[0] == chunk:
                found = self.piece(chunk)
            else:
                found = b"".join([self[p] for p in pieces])
        if len(chunk) <= 64:
            self[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        if len(self) > MEMO_WORDS:
            self.old = self.copy()
            self.clear()
        for blank in "\n\t\r":
            if blank in text:
                text = text.replace(blank, " ")
        return b"".join(map(self.__getitem__, text.split(" ")))


def _uint32(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


PIECE_FIELDS = [("piece", T.IntegerType(), pa.int32()), ("start", T.LongType(), pa.int64()),
                ("length", T.LongType(), pa.int64()), ("ids_crc32", T.LongType(), pa.int64()),
                ("__part", T.LongType(), pa.int64()), ("__nth", T.LongType(), pa.int64())]


def pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32, __part, __nth`` (and ``ids``) per piece."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        memo = word_ids(tokenizer_path)
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            rows, cols, ids = [], [[] for _ in PIECE_FIELDS], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                data = memo.encode(text or "") + end
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    cell = data[at:at + 4 * capacity]
                    length = len(cell) // 4
                    nth = seen[length] = seen.get(length, -1) + 1
                    rows.append(row)
                    for col, value in zip(cols, (piece, at // 4, length, zlib.crc32(cell), part, nth)):
                        col.append(value)
                    if with_ids:
                        ids.append(np.frombuffer(cell, "<i4"))
            out = [batch.column(0).take(pa.array(rows, pa.int64()))]
            out += [pa.array(c, kind) for c, (_, _, kind) in zip(cols, PIECE_FIELDS)]
            names = [id_col] + [f[0] for f in PIECE_FIELDS]
            if with_ids:
                off = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(off), pa.array(flat)))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names=names)

    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType)]
                          + [T.StructField(n, t) for n, t, _ in PIECE_FIELDS]
                          + ([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []))
    return df.select(id_col, text_col).mapInArrow(cut, schema)


# --- the plan -----------------------------------------------------------------

def price(value: np.ndarray, room: int) -> list[int]:
    """Knapsack by dynamic programming: class sizes 1..len(value) (repeats allowed) of most value in ``room``."""
    sizes = np.flatnonzero(value > 0) + 1
    gain = value[sizes - 1]
    best, pick = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for c in range(1, room + 1):
        k = int(np.searchsorted(sizes, c, "right"))
        best[c], pick[c] = best[c - 1], 0
        if k:
            total = best[c - sizes[:k]] + gain[:k]
            j = int(total.argmax())
            if total[j] > best[c]:
                best[c], pick[c] = total[j], sizes[j]
    out, c = [], room
    while c > 0:
        if pick[c]:
            out.append(int(pick[c]))
            c -= int(pick[c])
        else:
            c -= 1
    return out


def fractional(demand: np.ndarray, room: int, rounds: int = ROUNDS, part: float = 0.5, sharp: float = 40.0,
               skip: float = 0.0) -> list[tuple[dict[int, int], float]]:
    """Multiplicative weights for: cover ``demand[s - 1]`` pieces of class size s by configurations.

    A step covers ``part`` of what its scarcest class needs; configurations found before the share ``skip`` is covered
    only teach the weights.
    """
    need = demand.astype(float)
    live = need > 0
    covered, found = np.zeros(len(need)), {}
    for _ in range(rounds):
        share = np.where(live, covered / np.maximum(need, 1), np.inf)
        low = share.min()
        if low >= 1:
            break
        weight = np.where(live, np.exp(-sharp * np.minimum(share - low, 10.0)) / np.maximum(need, 1), 0.0)
        config = price(weight, room)
        sizes, copies = np.unique(config, return_counts=True)
        step = float((need[sizes - 1] / copies).min()) * part
        covered[sizes - 1] += step * copies
        if low >= skip:
            key = tuple(config)
            found[key] = found.get(key, 0.0) + step
    out = []
    grown = 1.0 / (1.0 - skip)                        # in place of what the skipped ones covered
    used = np.zeros(len(need))
    for config, times in found.items():
        np.add.at(used, np.array(config) - 1, times * grown)
    over = np.maximum(used / np.maximum(need, 1), 1.0)
    for config, times in found.items():
        sizes, copies = np.unique(config, return_counts=True)
        out.append((dict(zip(sizes.tolist(), copies.tolist())), times * grown / over[sizes - 1].max()))
    return out


class _Stock:
    """Pieces not yet placed, by length."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.count = np.zeros(capacity + 1, np.int64)
        for length, n in histogram.items():
            self.count[length] = n
        self.refresh()

    def refresh(self):
        self.lengths = np.flatnonzero(self.count)

    def largest(self, room: int) -> int:
        """Largest length left that fits, 0 if none."""
        k = int(np.searchsorted(self.lengths, room, "right")) - 1
        while k >= 0:
            if self.count[self.lengths[k]] > 0:
                return int(self.lengths[k])
            k -= 1
        return 0


def _fill(stock: _Stock, config: dict[int, int], times: int, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Add best-fitting lengths to ``times`` sequences of ``config`` (already taken from the stock)."""
    out, todo = [], [(config, times)]
    while todo:
        config, times = todo.pop()
        room = capacity - sum(l * a for l, a in config.items())
        fit = stock.largest(room) if room else 0
        if not fit:
            out.append((config, times))
            continue
        each = room // fit
        n = int(stock.count[fit])
        per, served = (each, min(times, n // each)) if n >= each else (n, 1)
        stock.count[fit] -= per * served
        todo.append(({**config, fit: config.get(fit, 0) + per}, served))
        if served < times:
            todo.append((config, times - served))
    return out


def prices(demand: np.ndarray, room: int, rounds: int = 600) -> np.ndarray:
    """Value of a piece of each class, the best configuration being worth 1: the average weights that bound most."""
    need = demand.astype(float)
    live = need > 0
    covered, total, best, out = np.zeros(len(need)), np.zeros(len(need)), -1.0, np.zeros(len(need))
    for number in range(1, rounds + 1 if live.any() else 1):
        share = np.where(live, covered / np.maximum(need, 1), np.inf)
        weight = np.where(live, np.exp(-40.0 * np.minimum(share - share.min(), 10.0)) / np.maximum(need, 1), 0.0)
        config = price(weight, room)
        sizes, copies = np.unique(config, return_counts=True)
        step = float((need[sizes - 1] / copies).min()) * 0.1
        covered[sizes - 1] += step * copies
        total += step * weight / weight[np.array(config) - 1].sum()
        if number % 20 == 0:
            worth = total[np.array(price(total, room)) - 1].sum()
            if (total @ need) / worth > best:
                best, out = (total @ need) / worth, total / worth
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Configurations (length -> copies) with multiplicities that hold every piece exactly once."""
    fine = dict(classes=4 * CLASSES, rounds=400, part=0.02, sharp=200.0, skip=0.3)
    tries = [plan_by_rounding(histogram, capacity, filler=capacity // 4), plan_by_rounding(histogram, capacity),
             plan_by_rounding(histogram, capacity, **fine), plan_by_prices(histogram, capacity)]
    return min(tries, key=lambda configs: sum(times for _, times in configs))


def _started(histogram: dict[int, int], capacity: int) -> tuple[_Stock, list[tuple[dict[int, int], int]]]:
    """The stock without the pieces that fill a sequence, and those."""
    stock, out = _Stock(histogram, capacity), []
    if stock.count[capacity]:
        out.append(({capacity: 1}, int(stock.count[capacity])))
        stock.count[capacity] = 0
        stock.refresh()
    return stock, out


def plan_by_prices(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """One configuration after the other by the classes' prices, of equal ones the fullest, as often as the stock allows."""
    stock, out = _started(histogram, capacity)
    g = max(1, capacity // CLASSES)
    classes, room = -(-np.arange(capacity + 1) // g), capacity // g          # rounded up: whatever is chosen fits

    def demand():
        return np.bincount(classes[1:], weights=stock.count[1:], minlength=room + 1)[1:room + 1]

    value = prices(demand(), room) + 1e-3 * np.arange(1, room + 1) / room
    by_class = [np.flatnonzero(classes == c) for c in range(room + 1)]
    while stock.count.any():
        sizes, copies = np.unique(price(np.where(demand() > 0, value, 0.0), room), return_counts=True)
        exact: dict[int, int] = {}
        for size, left in zip(sizes[::-1].tolist(), copies[::-1].tolist()):
            left -= size == sizes[0] and copies.sum() > 1                    # the smallest is chosen anew, best-fit
            for length in by_class[size][::-1]:
                use = min(left, int(stock.count[length]))
                if use:
                    exact[int(length)] = use
                    left -= use
        times = min(int(stock.count[length]) // use for length, use in exact.items())
        for length, use in exact.items():
            stock.count[length] -= use * times
        stock.refresh()
        out += _fill(stock, exact, times, capacity)
        stock.refresh()
    return out


def plan_by_rounding(histogram: dict[int, int], capacity: int = CAPACITY, filler: int = 0, classes: int = CLASSES,
                     **weights) -> list[tuple[dict[int, int], int]]:
    """The fractional solution rounded down, the rest filled in best-fit; pieces up to ``filler`` are kept for filling."""
    stock, out = _started(histogram, capacity)
    g = max(1, capacity // classes)
    classes = np.maximum(np.arange(capacity + 1) // g, 1)      # rounded down: the exact fit is made below
    room = capacity // g
    demand = np.bincount(classes[1:], weights=np.where(np.arange(1, capacity + 1) > filler, stock.count[1:], 0),
                         minlength=room + 1)[1:room + 1]
    by_class = [np.flatnonzero(classes == c) for c in range(room + 1)]
    open_configs = []
    for config, times in sorted(fractional(demand, room, **weights), key=lambda x: -x[1]):
        times = int(times)
        while times > 0:
            exact, run = {}, times
            for size, copies in config.items():
                left = copies - (size == min(config) and sum(config.values()) > 1)
                for length in by_class[size][::-1]:
                    n = int(stock.count[length])
                    free = capacity - sum(l * a for l, a in exact.items())
                    use = min(left, n, free // int(length)) if length > filler else 0
                    if use == 0:
                        continue
                    exact[int(length)] = use
                    run = min(run, n // use)
                    left -= use
                if left > 0 and not exact:
                    run = 0
            if run <= 0:
                break
            for length, use in exact.items():
                stock.count[length] -= use * run
            times -= run
            open_configs.append((exact, run))
    stock.refresh()
    open_configs.sort(key=lambda x: sum(l * a for l, a in x[0].items()), reverse=True)  # least room first
    for config, times in open_configs:
        out += _fill(stock, config, times, capacity)
    stock.refresh()
    while fit := stock.largest(capacity):
        n = int(stock.count[fit])
        stock.count[fit] = 0
        out += _fill(stock, {fit: 1}, n, capacity) if 2 * fit > capacity else _whole(stock, fit, n, capacity)
    return out


def _whole(stock: _Stock, fit: int, n: int, capacity: int) -> list[tuple[dict[int, int], int]]:
    """``n`` pieces of a length of which several fit: as many as fit in each, the last one filled up."""
    each = capacity // fit
    out = []
    if n // each:
        out += _fill(stock, {fit: each}, n // each, capacity)
    if n % each:
        out += _fill(stock, {fit: n % each}, 1, capacity)
    return out


def slots(configs: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, end rank, first sequence, copies, offset), sorted by length and rank."""
    rank, sequence, rows = {}, 0, []
    for config, times in configs:
        offset = 0
        for length, copies in sorted(config.items(), reverse=True):
            first = rank.get(length, 0)
            rank[length] = first + times * copies
            rows.append((length, first, rank[length], sequence, copies, offset))
            offset += length * copies
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pack(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of all rows with their place: ``id_col, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``)."""
    cut = store(pieces(df, tokenizer_path, id_col, text_col, capacity, end_id, with_ids), "pieces")
    runs = cut.groupBy("length", "__part").agg(F.count("*").alias("__n"))
    runs = store(runs, "piece_runs")
    histogram = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    table = df.sparkSession.sparkContext.broadcast(slots(plan(histogram, capacity)))
    before = F.sum("__n").over(Window.partitionBy("length").orderBy("__part")) - F.col("__n")
    base = runs.select(F.col("length").alias("__len"), F.col("__part").alias("__p"), before.alias("__before"))
    ranked = (cut.join(base, (F.col("length") == F.col("__len")) & (F.col("__part") == F.col("__p")))
              .withColumn("__rank", F.col("__before") + F.col("__nth")).drop("__part", "__nth", "__len", "__p", "__before"))

    def place(batches):
        rows = table.value
        span = np.int64(rows[:, 2].max() + 1 if len(rows) else 1)
        keys = rows[:, 0] * span + rows[:, 1]
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("__rank"))
            k = np.searchsorted(keys, length * span + rank, "right") - 1
            at, nth = rows[k], rank - rows[k, 1]
            names = [n for n in batch.schema.names if n != "__rank"]
            cols = [batch.column(n) for n in names]
            cols += [pa.array(at[:, 3] + nth // at[:, 4]), pa.array(at[:, 5] + nth % at[:, 4] * length)]
            yield pa.RecordBatch.from_arrays(cols, names=names + ["sequence_id", "offset"])

    schema = T.StructType([f for f in ranked.schema if f.name != "__rank"]
                          + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)
