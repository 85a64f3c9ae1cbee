"""Seeds for finding repeated stretches: winnowed anchors and the segments around them.

A text is a sequence of units (bytes or words); a window is ``length`` units of
one text.  Each window's anchor is its smallest-hashed run of ``gram`` units, the
leftmost if several.  Consecutive windows with the same anchor form a segment.
Equal windows have equal anchors at the same place, wherever they occur, so a
window can only repeat where its anchor's hash occurs again.

Hence: (1) segments are listed with their anchor hash and content hash; (2)
anchors that occur once are dropped (grouped counts, combined map-side); (3)
where all segments of an anchor are equal, every window of them repeats; (4) the
others, each distinct segment once, go to the caller's exact comparison.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import RID, byte_slices, drop_stored, store, text_buffer
from corvid.llm.hashing import BYTE_VALUE, Stretches, gram_hashes, word_hashes, words

CHUNK = 1 << 20     # windows hashed at a time
_POS = np.uint64((1 << 24) - 1)


def byte_units(data: np.ndarray, off: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_VALUE[which][data], off


def word_units(data: np.ndarray, off: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    start, end, first = words(data, off)
    if not len(start):
        return np.zeros(0, np.uint64), first
    return word_hashes(data, start, end, which), first


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    span, m = 1, v
    while 2 * span <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[:len(v) - width + 1], m[width - span:][:len(v) - width + 1]) if width > span else m


def segments(values: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text number, first window in the text, windows, anchor's place in the segment, anchor hash, content hash)."""
    parts = []
    for lo in range(0, max(0, len(values) - length + 1), CHUNK):
        chunk = values[lo:lo + CHUNK + length - 1]
        n = len(chunk) - length + 1
        hashes = Stretches(chunk)
        at = np.arange(len(chunk) - gram + 1)
        grams = hashes.hash(at, at + gram)
        marked = (grams & ~_POS) | at.astype(np.uint64)
        anchor = (sliding_min(marked, length - gram + 1) & _POS).astype(np.int64)
        # windows inside one text: between its start and ``length`` units before its end
        edge = np.zeros(n + 1, np.int32)
        a, b = np.clip(off[:-1] - lo, 0, n), np.clip(off[1:] - length + 1 - lo, 0, n)
        real = b > a
        np.add.at(edge, a[real], 1)
        np.add.at(edge, b[real], -1)
        valid = np.cumsum(edge[:n]) > 0
        head = valid.copy()
        head[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        head[a[real]] = True                      # a text starts
        stop = np.zeros(n + 1, bool)
        stop[:n] = head | ~valid
        stop[n] = True
        first = np.flatnonzero(head)
        if not len(first):
            continue
        stops = np.flatnonzero(stop)
        count = stops[np.searchsorted(stops, first, "right")] - first
        doc = np.searchsorted(off, first + lo, "right") - 1
        parts.append((doc, first + lo - off[doc], count, anchor[first] - first, grams[anchor[first]].view(np.int64),
                      hashes.hash(first, first + count + length - 1).view(np.int64)))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*parts))


def listed(rows: DataFrame, units, length: int, gram: int) -> DataFrame:
    """(``a`` anchor hash, ``s`` content hash, ``__rid``, ``w`` first window, ``n`` windows, ``p`` anchor's place)."""
    def find(batches):
        for batch in batches:
            for part in byte_slices(batch, "__text"):
                values, off = units(*text_buffer(part.column("__text")))
                doc, first, count, place, anchor, content = segments(values, off, length, gram)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(content), part.column(RID).take(pa.array(doc)),
                     *[pa.array(x.astype(np.int32)) for x in (first, count, place)]], names=["a", "s", RID, "w", "n", "p"])

    return rows.select(RID, "__text").mapInArrow(find, f"a long, s long, {RID} long, w int, n int, p int")


def hits(rows: DataFrame, units, length: int, gram: int) -> DataFrame:
    """Stored segments whose anchor occurs elsewhere too; ``mixed`` where not all its segments are equal."""
    every = store(listed(rows, units, length, gram), "segments")
    again = (every.groupBy("a").agg(F.count("*").alias("__c"), F.min("s").alias("__lo"), F.max("s").alias("__hi"))
             .filter("__c > 1").select(F.col("a").alias("__a"), (F.col("__lo") != F.col("__hi")).alias("mixed")))
    found = store(every.join(again, F.col("a") == F.col("__a")).drop("__a"), "hits")
    drop_stored(every)
    return found


def distinct_segments(found: DataFrame) -> DataFrame:
    """Each distinct content of the mixed segments: ``a, s, copies`` and where one of them is."""
    one = F.min(F.struct(RID, "w", "n", "p")).alias("at")
    return (found.filter("mixed").groupBy("a", "s").agg(F.count("*").alias("copies"), one)
            .select("a", "s", "copies", "at.*"))


def with_texts(rows: DataFrame, places: DataFrame, fields: list[str]) -> DataFrame:
    """Texts joined with the array ``places`` of their entries (a text's own entries: bounded by its length)."""
    per_row = places.groupBy(RID).agg(F.collect_list(F.struct(*fields)).alias("places"))
    return rows.join(per_row.withColumnRenamed(RID, "__r"), F.col(RID) == F.col("__r")).drop("__r")


def window_hashes(rows: DataFrame, places: DataFrame, units, length: int) -> DataFrame:
    """(``h1``, ``h2``, ``a``, ``s``, ``i`` window in the segment, ``copies``) of every window of distinct segments."""
    def spread(batches):
        for batch in batches:
            for part in byte_slices(batch, "__text"):
                data, off = text_buffer(part.column("__text"))
                flat = part.column("places").flatten()
                per = np.diff(np.asarray(part.column("places").offsets))
                doc = np.repeat(np.arange(part.num_rows), per)
                w, n = (np.asarray(flat.field(f)).astype(np.int64) for f in ("w", "n"))
                cols = []
                inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                for which in (0, 1):
                    values, first = units(data, off, which)
                    start = np.repeat(first[doc] + w, n) + inner
                    cols.append(pa.array(gram_hashes(values, length)[start].view(np.int64)))
                pick = pa.array(np.repeat(np.arange(len(n)), n))
                yield pa.RecordBatch.from_arrays(
                    [*cols, *[flat.field(f).take(pick) for f in ("a", "s")], pa.array(inner.astype(np.int32)),
                     flat.field("copies").take(pick)], names=["h1", "h2", "a", "s", "i", "copies"])

    joined = with_texts(rows, places, ["w", "n", "a", "s", "copies"]).select("__text", "places")
    return joined.mapInArrow(spread, "h1 long, h2 long, a long, s long, i int, copies long")


def repeated_windows(windows: DataFrame) -> DataFrame:
    """(``a``, ``s``, ``i``) of the windows that occur at least twice, copies counted."""
    again = (windows.groupBy("h1", "h2").agg(F.sum("copies").alias("__c")).filter("__c > 1")
             .select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2")))
    return (windows.join(again, (F.col("h1") == F.col("__h1")) & (F.col("h2") == F.col("__h2")))
            .select("a", "s", "i"))


def runs_of(windows: DataFrame) -> DataFrame:
    """Maximal runs (``a``, ``s``, ``w0`` first window, ``n``) of consecutive windows per segment."""
    listed = windows.groupBy("a", "s").agg(F.collect_set("i").alias("i"))
    heads = F.sort_array(F.filter("i", lambda x: ~F.array_contains("i", x - 1)))
    tails = F.sort_array(F.filter("i", lambda x: ~F.array_contains("i", x + 1)))
    return (listed.select("a", "s", F.explode(F.arrays_zip(heads.alias("h"), tails.alias("t"))).alias("r"))
            .select("a", "s", F.col("r")["h"].alias("w0"), (F.col("r")["t"] - F.col("r")["h"] + 1).alias("n")))


def covered(found: DataFrame, runs: DataFrame) -> DataFrame:
    """Stored: per row the repeated windows as ``ranges``, an array of (first window ``w``, windows ``n``).

    ``runs``: the runs of repeated windows (``a``, ``s``, ``w0``, ``n``) in mixed segments.
    """
    again = runs.select(F.col("a").alias("__a"), F.col("s").alias("__s"), "w0", F.col("n").alias("__n"))
    mixed = (found.filter("mixed").join(again, (F.col("a") == F.col("__a")) & (F.col("s") == F.col("__s")))
             .select(RID, (F.col("w") + F.col("w0")).alias("w"), F.col("__n").alias("n")))
    every = found.filter("not mixed").select(RID, "w", "n").unionByName(mixed)
    return store(every.groupBy(RID).agg(F.collect_list(F.struct("w", "n")).alias("ranges")), "ranges")


def covered_units(n_units: int, ranges: tuple[np.ndarray, np.ndarray], length: int) -> np.ndarray:
    """Which units of a text lie in a repeated window (``ranges``: first windows and window counts)."""
    edge = np.zeros(n_units + 1, np.int32)
    np.add.at(edge, ranges[0], 1)
    np.add.at(edge, ranges[0] + ranges[1] + length - 1, -1)
    return np.cumsum(edge[:-1]) > 0
