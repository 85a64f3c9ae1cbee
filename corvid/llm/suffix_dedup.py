"""Suffix-array dedup: repeated byte strings by interval expansion on a Burrows-Wheeler transform.

Texts are split into segments around winnowed anchors (:mod:`corvid.llm.seeds`,
units are bytes): two equal windows of ``LENGTH`` bytes lie in segments with the
same anchor hash.  Equal segments are merged first, keeping their number; an
anchor all of whose segments are equal needs no further comparison.  All other
distinct segments are dealt to tasks by anchor.  A task sorts the segments of an
anchor by what follows it and by what precedes it; the common parts of
neighbours bound how far each segment can agree with any other, and what lies
beyond is cut off.  The task joins what is left, each distinct string once, with
unique separators, builds their suffix array and Burrows-Wheeler transform and
derives common prefixes by increasing value: interval boundaries of value v
yield those of value v + 1 by one backward-extension step, and the search stops
at ``LENGTH``.  Neighbouring suffixes without a boundary by then share at least
``LENGTH`` bytes: their windows repeat.

Skew: an anchor with more than ``HOT_SEGMENTS`` distinct segments, more than a
block holds (a stretch common to very many texts that go on differently) is not dealt out at all.  Its
windows are counted by 128-bit hash, combined map-side; windows that occur once
cannot repeat.  The others are confirmed by their bytes, dealt by (anchor, hash):
the least and the greatest bytes of a hash are equal unless different windows
share it, and such windows are counted by their bytes.  So no task holds an anchor,
however many distinct stretches of it repeat.

Defined cases: a null or empty text has no bytes; a text shorter than a window
loses nothing; repeated rows are copies of each other; null ids are kept; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import RID, byte_slices, drop_stored, numbered, store, text_buffer
from corvid.llm.hashing import Stretches
from corvid.llm.seeds import (byte_units, covered, covered_units, distinct_segments, hits, repeated_windows, runs_of,
                              window_hashes, with_texts)

LENGTH = 200
GRAM = 32
BLOCK = 4 << 20      # bytes of segments compared at a time
HOT_SEGMENTS = BLOCK // 256      # as many as one block holds


# --- one block: suffix array, transform, bounded common prefixes -------------------

def suffix_array(symbols: np.ndarray, separators: int, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols or more, by prefix doubling.

    Symbols below ``separators`` are unique; the rest are bytes plus
    ``separators``.  The first ranks compare 7 symbols packed in one number.
    """
    n = len(symbols)
    is_end = symbols < separators
    code = np.where(is_end, 0, symbols - separators + 1)
    packed, ended = code.copy(), is_end.copy()
    code, is_end = np.append(code, np.zeros(7, np.int64)), np.append(is_end, np.ones(7, bool))
    for i in range(1, 7):
        packed *= 257
        packed += np.where(ended, 0, code[i:n + i])
        ended |= is_end[i:n + i]
    order = np.argsort(packed)
    key = packed
    rank, h = np.empty(n, np.int64), 7
    while True:
        # stretches that reach a separator equal no other
        new = np.ones(n, bool)
        new[1:] = (key[order[1:]] != key[order[:-1]]) | ended[order[1:]]
        number = np.cumsum(new) - 1
        rank[order] = number
        if h >= depth or number[-1] == n - 1:
            return order
        key = rank * (n + 1)
        key[:max(0, n - h)] += rank[h:] + 1
        reach = np.ones(n, bool)
        reach[:max(0, n - h)] = ended[h:]
        ended = ended | reach
        order = np.argsort(key)
        h *= 2


def bounded_prefixes(symbols: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the array; ``limit`` where it is that or more."""
    n = len(symbols)
    lcp = np.full(n, -1, np.int32)
    place = np.empty(n, np.int64)
    place[sa] = np.arange(n)
    bwt = symbols[sa - 1]                          # the symbol before each suffix (cyclic)
    first = symbols[sa]
    heads = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
    lcp[heads] = 0
    alphabet, starts, counts = np.unique(first, return_index=True, return_counts=True)
    several = counts > 1                           # a symbol that occurs once extends nothing
    by_symbol = np.argsort(bwt, kind="stable")     # rows grouped by their preceding symbol, in order
    groups = [(int(s), by_symbol[s:s + c]) for s, c in zip(starts[several], counts[several])]
    frontier = heads
    for value in range(1, limit):
        if not len(frontier):
            break
        found = []
        if len(frontier) * 8 > n // 4:             # many boundaries: one running count serves every symbol
            upto = np.zeros(n + 1, np.int32)
            upto[frontier + 1] = 1
            np.cumsum(upto, out=upto)
            for start, rows in groups:
                between = upto[rows[1:] + 1] - upto[rows[:-1] + 1]
                found.append(start + 1 + np.flatnonzero(between))
        else:
            for start, rows in groups:
                k = np.searchsorted(rows, frontier, "left")
                found.append(start + k[(k > 0) & (k < len(rows))])
        reached = np.concatenate(found) if found else np.zeros(0, np.int64)
        reached = reached[lcp[reached] < 0]
        lcp[reached] = value
        frontier = np.unique(reached)
    lcp[lcp < 0] = limit
    return lcp


def agreement(anchor: np.ndarray, texts: list[bytes]) -> np.ndarray:
    """Longest common beginning of each text with any other of the same anchor."""
    n = len(texts)
    order = np.array(sorted(range(n), key=lambda j: (anchor[j], texts[j])), np.int64)
    sizes = np.array([len(texts[j]) for j in order])
    width = int(sizes.max(initial=0)) + 1
    rows = np.frombuffer(b"".join(texts[j].ljust(width, b"\0") for j in order), np.uint8).reshape(n, width)
    with_next = np.zeros(n + 1, np.int64)
    for lo in range(0, n - 1, 1 << 14):
        hi = min(n - 1, lo + (1 << 14))
        differ = rows[lo:hi] != rows[lo + 1:hi + 1]
        differ[:, -1] = True
        with_next[lo + 1:hi + 1] = np.minimum(differ.argmax(axis=1), np.minimum(sizes[lo:hi], sizes[lo + 1:hi + 1]))
    with_next[1:n][anchor[order[1:]] != anchor[order[:-1]]] = 0
    out = np.zeros(n, np.int64)
    out[order] = np.maximum(with_next[:-1], with_next[1:])
    return out


def clipped(anchor: np.ndarray, place: np.ndarray, copies: np.ndarray, texts: list[bytes],
            length: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the part of each segment that may hold repeated windows (empty if none)."""
    right = agreement(anchor, [t[p:] for t, p in zip(texts, place.tolist())])
    left = agreement(anchor, [t[:p][::-1] for t, p in zip(texts, place.tolist())])
    start, end = place - left, place + right
    many = copies > 1
    start[many] = 0
    end[many] = np.array([len(t) for t in texts])[many]
    end[end - start < length] = 0
    start[end == 0] = 0
    return start, end


def repeated_starts(segments: list[bytes], copies: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) of the windows that occur twice among the segments, counting ``copies``."""
    m = len(segments)
    sizes = np.array([len(s) for s in segments])
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8).astype(np.int64) + m
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = np.arange(m)                      # a unique separator after each segment
    sa = suffix_array(text, m, length)
    lcp = bounded_prefixes(text, sa, length)
    deep = np.flatnonzero(lcp >= length)
    at = np.unique(np.concatenate([sa[deep], sa[deep - 1]]))
    seg = np.searchsorted(ends, at, "left")
    win = at - (ends[seg] - sizes[seg])
    many = np.flatnonzero((copies > 1) & (sizes >= length))    # every window of a copied segment repeats
    spans = sizes[many] - length + 1
    all_seg = np.concatenate([seg, np.repeat(many, spans)])
    inner = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
    both = np.unique(all_seg * (sizes.max() + 1) + np.concatenate([win, inner]))
    return both // (sizes.max() + 1), both % (sizes.max() + 1)


def block_starts(anchor: np.ndarray, place: np.ndarray, copies: np.ndarray, texts: list[bytes],
                 length: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) of repeated windows among the segments of some anchors."""
    start, end = clipped(anchor, place, copies, texts, length)
    live = np.flatnonzero(end)
    if not len(live):
        return live, live
    number: dict[bytes, int] = {}
    of = np.array([number.setdefault(texts[j][start[j]:end[j]], len(number)) for j in live], np.int64)
    total = np.bincount(of, weights=copies[live], minlength=len(number)).astype(np.int64)
    seg, win = repeated_starts(list(number), total, length)
    # back from distinct strings to all segments that hold them
    by = np.argsort(of, kind="stable")
    first = np.searchsorted(of[by], np.arange(len(number) + 1))
    holders = first[seg + 1] - first[seg]
    pick = by[np.repeat(first[seg], holders) + np.arange(holders.sum()) - np.repeat(np.cumsum(holders) - holders, holders)]
    return live[pick], np.repeat(win, holders) + start[live[pick]]


def compare(pieces: DataFrame, length: int) -> DataFrame:
    """Runs (``a``, ``s``, ``w0`` first window, ``n``) of repeated windows among ``pieces`` (``a, s, copies, p, bytes``), by anchor."""
    dealt = pieces.repartition("a").sortWithinPartitions("a", "s")

    def search(batches):
        def block(parts):
            a, s, copies, place, text = (np.concatenate([x[i] for x in parts]) for i in range(5))
            seg, win = block_starts(a, place.astype(np.int64), copies, list(text), length)
            by = np.lexsort((win, seg))
            seg, win = seg[by], win[by]
            head = np.ones(len(seg), bool)
            head[1:] = (seg[1:] != seg[:-1]) | (win[1:] != win[:-1] + 1)
            first = np.flatnonzero(head)
            n = np.diff(np.append(first, len(seg)))
            return pa.RecordBatch.from_arrays(
                [pa.array(a[seg[first]]), pa.array(s[seg[first]]), pa.array(win[first].astype(np.int32)),
                 pa.array(n.astype(np.int32))], names=["a", "s", "w0", "n"])

        held, size = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                text = np.empty(part.num_rows, object)
                text[:] = part.column(4).to_pylist()
                held.append(tuple(np.asarray(part.column(i)) for i in range(4)) + (text,))
                size += sum(map(len, text))
                if size >= BLOCK and held[0][0][0] != held[-1][0][-1]:
                    whole = [np.concatenate([x[i] for x in held]) for i in range(5)]
                    cut = int(np.searchsorted(whole[0], whole[0][-1]))     # the last, open anchor stays
                    yield block([tuple(x[:cut] for x in whole)])
                    held = [tuple(x[cut:] for x in whole)]
                    size = sum(map(len, held[0][4]))
        if held:
            yield block(held)

    return dealt.select("a", "s", "copies", "p", "bytes").mapInArrow(search, "a long, s long, w0 int, n int")


# --- hot anchors ---------------------------------------------------------------------

def window_bytes(rows: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """``h1, h2, a, s, i, copies, bytes`` of every window of ``places`` (``__rid, w, n, a, s, copies, w0``)."""
    def spread(batches):
        for batch in batches:
            for part in byte_slices(batch, "__text"):
                data, off = text_buffer(part.column("__text"))
                raw = data.tobytes()
                flat = part.column("places").flatten()
                doc = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(part.column("places").offsets)))
                w, n, w0 = (np.asarray(flat.field(f)).astype(np.int64) for f in ("w", "n", "w0"))
                sums = [Stretches(byte_units(data, off, which)[0], which) for which in (0, 1)]
                ends = np.cumsum(n)
                for lo in range(0, int(n.sum()), 1 << 14):
                    at = np.arange(lo, min(lo + (1 << 14), int(n.sum())))
                    place = np.searchsorted(ends, at, "right")
                    inner = at - ends[place] + n[place]
                    start = off[doc[place]] + w[place] + inner
                    pick = pa.array(place)
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(x.hash(start, start + length).view(np.int64)) for x in sums],
                         *[flat.field(f).take(pick) for f in ("a", "s")], pa.array((w0[place] + inner).astype(np.int32)),
                         flat.field("copies").take(pick), pa.array([raw[x:x + length] for x in start.tolist()], pa.binary())],
                        names=["h1", "h2", "a", "s", "i", "copies", "bytes"])

    joined = with_texts(rows, places, ["w", "n", "a", "s", "copies", "w0"]).select("__text", "places")
    return joined.mapInArrow(spread, "h1 long, h2 long, a long, s long, i int, copies long, bytes binary")


def equal_windows(windows: DataFrame) -> DataFrame:
    """(``a``, ``s``, ``i``) of the ``windows`` (as of :func:`window_bytes`) whose bytes occur at least twice, copies counted."""
    key = ["a", "h1", "h2"]
    classes = store(windows.groupBy(*key).agg(F.sum("copies").alias("c"), F.min("bytes").alias("lo"), F.max("bytes").alias("hi"))
                    .filter("c > 1").select(*[F.col(x).alias(f"__{x}") for x in key], (F.col("lo") == F.col("hi")).alias("one")),
                    "classes")
    same = (F.col("a") == F.col("__a")) & (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2"))
    found = windows.drop("bytes").join(classes.filter("one"), same).select("a", "s", "i")
    mixed = classes.filter("not one")
    if mixed.isEmpty():
        return found
    # different windows of one hash
    odd = store(windows.join(mixed, same, "left_semi"), "odd")
    again = odd.groupBy("a", "bytes").agg(F.sum("copies").alias("c")).filter("c > 1").select("a", "bytes")
    return found.unionByName(odd.join(again, ["a", "bytes"]).select("a", "s", "i"))


# --- the whole ----------------------------------------------------------------------

def stretches(rows: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """``a, s, copies, w0, p, bytes`` of ``places`` (those fields but ``bytes``, and ``__rid``, ``w``, ``n``)."""
    def cut(batches):
        for batch in batches:
            for part in byte_slices(batch, "__text"):
                data, off = text_buffer(part.column("__text"))
                raw = data.tobytes()
                flat = part.column("places").flatten()
                doc = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(part.column("places").offsets)))
                start = off[doc] + np.asarray(flat.field("w"))
                end = start + np.asarray(flat.field("n")) + length - 1
                texts = [raw[x:y] for x, y in zip(start.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays([*[flat.field(f) for f in ("a", "s", "copies", "w0", "p")],
                                                  pa.array(texts, pa.binary())],
                                                 names=["a", "s", "copies", "w0", "p", "bytes"])

    joined = with_texts(rows, places, ["w", "n", "a", "s", "copies", "w0", "p"]).select("__text", "places")
    return joined.mapInArrow(cut, "a long, s long, copies long, w0 int, p int, bytes binary")


def repeated_ranges(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_SEGMENTS) -> DataFrame:
    """``__rid`` and ``ranges`` of repeated windows, for numbered rows that have any."""
    found = hits(rows, byte_units, length, gram)
    distinct = store(distinct_segments(found), "distinct")
    crowded = store(distinct.groupBy("a").agg(F.count("*").alias("k")).filter(F.col("k") > hot)
                    .select(F.col("a").alias("__a")), "crowded")
    calm = distinct.join(crowded, F.col("a") == F.col("__a"), "left_anti").withColumn("w0", F.lit(0))
    crowd = store(distinct.join(crowded, F.col("a") == F.col("__a"), "left_semi"), "crowd")
    # hot anchors: only windows whose hash occurs again, then compared by their bytes
    windows = store(window_hashes(rows, crowd, byte_units, length), "windows")
    parts = (runs_of(repeated_windows(windows)).withColumnRenamed("n", "__n").join(crowd, ["a", "s"])
             .select(RID, "a", "s", "copies", "w0", (F.col("w") + F.col("w0")).alias("w"), F.col("__n").alias("n")))
    parts = store(parts, "hot_parts")
    hot_runs = store(runs_of(equal_windows(window_bytes(rows, parts, length))), "hot_runs")
    fields = [RID, "a", "s", "copies", "w0", "w", "n", "p"]
    pieces = store(stretches(rows, calm.select(fields), length), "pieces")
    for done in (distinct, crowded, crowd, windows, parts):
        drop_stored(done)
    unique = (pieces.withColumn("t", F.xxhash64("bytes", F.lit(1)))
              .groupBy("a", "t", "p", "bytes").agg(F.sum("copies").alias("copies")))
    repeated = store(compare(unique.select("a", F.col("t").alias("s"), "copies", "p", "bytes"), length), "repeated")
    back = (pieces.select(F.col("a").alias("__a"), F.col("s").alias("__s"), F.col("w0").alias("__w"),
                          F.xxhash64("bytes", F.lit(1)).alias("__t"))
            .join(repeated, (F.col("__a") == F.col("a")) & (F.col("__t") == F.col("s")))
            .select(F.col("__a").alias("a"), F.col("__s").alias("s"), (F.col("w0") + F.col("__w")).alias("w0"), "n"))
    ranges = covered(found, back.unionByName(hot_runs.select("a", "s", "w0", "n")))
    for done in (pieces, repeated, hot_runs, found):
        drop_stored(done)
    return ranges


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, hot: int = HOT_SEGMENTS, with_bytes: bool = True) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, the remaining bytes) per row."""
    rows = numbered(df, id_col, text_col)
    ranges = repeated_ranges(rows, length, gram, hot)
    joined = rows.join(ranges.withColumnRenamed(RID, "__r"), F.col(RID) == F.col("__r"), "left").drop("__r")
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes

    def cut(batches):
        for batch in batches:
            data, off = text_buffer(batch.column(1))
            spans = batch.column(2)
            at, flat = np.asarray(spans.offsets), spans.values
            w, n = np.asarray(flat.field("w")).astype(np.int64), np.asarray(flat.field("n")).astype(np.int64)
            size, gone, runs, sha, kept = [], [], [], [], []
            for row in range(batch.num_rows):
                text = data[off[row]:off[row + 1]]
                size.append(len(text))
                lo, hi = at[row], at[row + 1]
                if spans[row].is_valid and hi > lo:
                    inside = covered_units(len(text), (w[lo:hi], n[lo:hi]), length)
                    gone.append(int(inside.sum()))
                    runs.append(int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum()))
                    text = text[~inside]
                else:
                    gone.append(0)
                    runs.append(0)
                left = text.tobytes()
                sha.append(hashlib.sha256(left).hexdigest())
                if with_bytes:
                    kept.append(left)
            cols = [batch.column(0), *[pa.array(x, pa.int64()) for x in (size, gone, runs)], pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.binary())] * with_bytes, names=names)

    fields = [T.StructField(id_col, df.schema[id_col].dataType)]
    fields += [T.StructField(x, T.LongType()) for x in ("n_bytes", "n_removed", "n_spans")]
    fields += [T.StructField("kept_sha256", T.StringType())] + [T.StructField("kept", T.BinaryType())] * with_bytes
    return joined.select("__id", "__text", "ranges").mapInArrow(cut, T.StructType(fields))
