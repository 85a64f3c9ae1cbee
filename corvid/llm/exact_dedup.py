"""Exact dedup by an extendible-hash index on shared files (DataFrame functions only).

1. Every row gets a 64-bit key of its normalised text; the entries
   (row, key, digest) are written to the shared folder.
2. Entries are counted per key (combined map-side).  The directory maps the
   leading bits of a key to a bucket: starting from one bucket of depth 0, a
   bucket with more than ``capacity`` keys splits on its next bit, doubling the
   directory where needed.  It is computed from key counts per cell of 2^depth
   cells, level by level, so it has a bounded number of rows.
3. Owner tasks process buckets: keys that several rows share form chains; the
   texts of a chain are compared byte by byte (grouped by bucket, key and text,
   combined map-side, so a hot text costs one row a task).
4. The result of each chain is joined back to the entries.

Defined cases: a null text counts as empty; empty texts equal each other; of
equal texts the row with the largest id stays, a null id is smaller than any;
of rows that repeat id and text one stays; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.llm.common import RID, store, with_row_ids

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKET_KEYS = 1 << 16
MAX_DEPTH = 24


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; for pure ASCII text that is the plain ``lower``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def directory(keys: DataFrame, n_keys: int, capacity: int = BUCKET_KEYS) -> tuple[DataFrame, int]:
    """(``cell``, ``bucket``, ``depth``) for each cell of leading key bits, and the cell bits.

    A bucket is (depth, leading bits); its depth is the first at which it has
    at most ``capacity`` keys (or the finest depth of the directory).
    """
    finest = min(MAX_DEPTH, max(1, math.ceil(math.log2(max(2, n_keys / capacity))) + 3))
    cells = keys.groupBy(F.shiftrightunsigned("__key", 64 - finest).alias("cell")).agg(F.count("*").alias("keys"))
    levels = cells
    for depth in range(1, finest):
        prefix = F.shiftright("cell", finest - depth)
        load = cells.groupBy(prefix.alias(f"p{depth}")).agg(F.sum("keys").alias(f"load{depth}"))
        levels = levels.join(load, prefix == F.col(f"p{depth}")).drop(f"p{depth}")
    splits = [F.when(F.col(f"load{d}") <= capacity, F.lit(d)) for d in range(1, finest)]
    depth = F.coalesce(*splits, F.lit(finest))
    leaves = levels.select("cell", depth.alias("depth"))
    bucket = F.concat_ws(":", "depth", F.expr(f"shiftright(cell, {finest} - depth)"))
    return leaves.select("cell", bucket.alias("bucket"), "depth"), finest


def index(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Index entries: whole rows (``__row``) with row id, id, key and digest of the normalised text."""
    rows = with_row_ids(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")))
    rows = rows.select(RID, "__row", F.col("__row")[id_col].alias("__id"),
                       ascii_lower(F.coalesce(F.col("__row")[text_col], F.lit(""))).alias("__norm"))
    return rows.select(RID, "__id", "__row", F.xxhash64("__norm").alias("__key"), F.sha2("__norm", 256).alias("__sha"))


def groups_of(entries: DataFrame, text_col: str, capacity: int = BUCKET_KEYS) -> DataFrame:
    """Result rows for stored index entries (see :func:`exact_groups`)."""
    slim = entries.select(RID, "__id", "__key", "__sha")
    keys = store(slim.groupBy("__key").agg(F.count("*").alias("__n")), "index_keys")
    leaves, bits = directory(keys, keys.count(), capacity)
    leaves = store(leaves, "index_directory")
    owned = (keys.withColumn("cell", F.shiftrightunsigned("__key", 64 - bits)).join(leaves, "cell")
             .select("__key", "__n", "bucket", "depth"))
    chains = owned.filter("__n > 1").select(F.col("__key").alias("__k"), "bucket")
    raw = F.coalesce(F.col("__row")[text_col], F.lit("")).alias("__raw")
    texts = (entries.select(RID, "__id", raw, "__key", "__sha").join(chains, F.col("__key") == F.col("__k"))
             .groupBy("bucket", "__key", "__sha", ascii_lower(F.col("__raw")).alias("__norm"))
             .agg(F.max(F.struct("__id", RID)).alias("__last"), F.count("*").alias("group_size"))
             .select(F.col("__key").alias("__k"), F.col("__sha").alias("__s"), "__last", "group_size"))
    lookup = (owned.withColumnRenamed("__key", "__o").join(texts, F.col("__o") == F.col("__k"), "left")
              .drop("__k", "__n"))
    last = F.coalesce("__last", F.struct("__id", RID))
    return (slim.join(lookup, (F.col("__key") == F.col("__o"))
                      & (F.col("__s").isNull() | (F.col("__s") == F.col("__sha"))))
            .select(RID, "__id", last["__id"].alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    (last[RID] == F.col(RID)).alias("kept"), F.col("__sha").alias("text_sha256"),
                    "bucket", "depth"))


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 capacity: int = BUCKET_KEYS) -> DataFrame:
    """One row per input row: ``__rid, __id, keep_id, group_size, kept, text_sha256, bucket, depth``."""
    entries = store(index(df.select(id_col, text_col), id_col, text_col), "index")
    return groups_of(entries, text_col, capacity)


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      capacity: int = BUCKET_KEYS) -> DataFrame:
    """The rows of ``df`` that stay, all columns unchanged."""
    entries = store(index(df, id_col, text_col), "index")
    kept = groups_of(entries, text_col, capacity).filter("kept").select(RID)
    return entries.join(kept, RID, "left_semi").select("__row.*")
