"""Helpers shared by the operators: scratch tables, row ids, Arrow text buffers.

Row ids: operators that join results back to rows number the rows once, in a
table written to the shared scratch folder, so that repeated ids, null ids and
lost executors cannot mix rows up.  Working columns start with ``__``; every
operator selects the input columns it needs first, so extra columns of an
input never clash with them.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.session import scratch_path

RID = "__rid"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: what was written survives lost executors and is computed
    once however often it is read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")   # the shuffles of this write are not needed once it is done
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the scratch files behind a table made by :func:`store`, once nothing reads it any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def give_memory_back() -> None:
    """Return what this process has freed to the system: glibc and Arrow keep it otherwise, over all later steps."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # another C library
        pass


def with_row_ids(df: DataFrame) -> DataFrame:
    """``df`` plus a unique long ``__rid``; wrap in :func:`store` before joining on it."""
    return df.withColumn(RID, F.monotonically_increasing_id())


def numbered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored rows (``__rid``, ``__id``, ``__text``); a null text becomes empty."""
    rows = df.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    return store(with_row_ids(rows), "rows")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary column and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type)
                                  or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if large else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def byte_slices(batch: pa.RecordBatch, text_col: str | int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` text bytes (one row at least)."""
    _, off = text_buffer(batch.column(text_col))
    start, n = 0, batch.num_rows
    while start < n:
        stop = max(start + 1, int(np.searchsorted(off, off[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


def salt_count(rows: int, per_group: int) -> int:
    """Number of salts so that a hot group of all rows has about ``per_group`` rows a salt."""
    return max(1, math.ceil(rows / per_group))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(``node``, ``component`` = smallest node reachable) for undirected edges (``a``, ``b``).

    Alternating large-star / small-star contraction: each round is two grouped
    minima (combined map-side, so a node with very many links costs one row a
    task) and two equi-joins AQE can split; rounds are written to the shared
    scratch folder.  Ends when a round changes nothing.
    """
    pairs = store(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of u links to u's smallest neighbour (or u)
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # small star: smaller neighbours of u and u itself link to the smallest of them
        large = store(large, "cc")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))
                 .filter("u <> v").distinct())
        after = store(small, "cc")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        drop_stored(large)
        drop_stored(pairs)
        pairs = after
        if tuple(state) == before:
            break
        before = tuple(state)
    else:
        raise RuntimeError("components did not settle; raise max_rounds")
    return (pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
