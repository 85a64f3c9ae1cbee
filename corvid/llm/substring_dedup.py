"""Substring dedup by seeds and window hashes, over words.

Seeds are winnowed anchors of ``GRAM`` words (see :mod:`corvid.llm.seeds`): any
window of ``LENGTH`` words holds one.  Anchors only filter: one found once has no
match.  Segments are the stretches of windows around an anchor; where all segments
of an anchor have the same hash, all of it repeats.  Of the others, each distinct
segment once, every window of ``LENGTH`` words is counted by its 128-bit hash,
combined map-side, so that an anchor in a third of all rows makes no pairs and no
large group.  No occurrence is extended and no two are compared: equal hashes count
as equal words.  The union of repeated windows of a text are its maximal repeats
over the length threshold; their words are removed.

Defined cases: a null or empty text has no words; a text shorter than a window
loses nothing; repeated rows are copies of each other; null ids are kept; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import RID, drop_stored, numbered, store
from corvid.llm.seeds import (covered, covered_units, distinct_segments, hits, repeated_windows, runs_of,
                              window_hashes, word_units)

LENGTH = 35
GRAM = 8


def repeated_ranges(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``__rid`` and ``ranges`` of repeated windows, for numbered rows that have any."""
    found = hits(rows, word_units, length, gram)
    windows = store(window_hashes(rows, distinct_segments(found), word_units, length), "windows")
    ranges = covered(found, runs_of(repeated_windows(windows)))
    drop_stored(windows)
    drop_stored(found)
    return ranges


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """``id_col, n_words, n_removed, kept_sha256`` (and ``kept_text``) per row."""
    rows = numbered(df, id_col, text_col)
    ranges = repeated_ranges(rows, length, gram)
    joined = rows.join(ranges.withColumnRenamed(RID, "__r"), F.col(RID) == F.col("__r"), "left").drop("__r")
    names = [id_col, "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text

    def cut(batches):
        for batch in batches:
            ns, gone, sha, kept = [], [], [], []
            spans = batch.column(2)
            off, flat = np.asarray(spans.offsets), spans.values
            w, n = np.asarray(flat.field("w")).astype(np.int64), np.asarray(flat.field("n")).astype(np.int64)
            for row, text in enumerate(batch.column(1)):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                ns.append(len(words))
                lo, hi = off[row], off[row + 1]
                if spans[row].is_valid and hi > lo:
                    inside = covered_units(len(words), (w[lo:hi], n[lo:hi]), length)
                    gone.append(int(inside.sum()))
                    words = list(compress(words, (~inside).tolist()))
                else:
                    gone.append(0)
                left = b" ".join(words)
                sha.append(hashlib.sha256(left).hexdigest())
                if with_text:
                    kept.append(left.decode())
            cols = [batch.column(0), pa.array(ns, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(kept, pa.string())] * with_text, names=names)

    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
              T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    fields += [T.StructField("kept_text", T.StringType())] * with_text
    return joined.select("__id", "__text", "ranges").mapInArrow(cut, T.StructType(fields))
