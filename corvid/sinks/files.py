"""File writers and cache scopes.

Writers run in the executors.  A single file means a single writer task, so the
one-file writer (K04) is for results that are small by nature (a report per
artist, a rate table); everything else is written as a multi-part folder.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.functions.dates import reformat_ymd

def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One line per row (columns joined by commas)."""
    line = F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False) -> None:
    df.write.mode(mode).option("header", header).csv(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_one_file(df: DataFrame, target: str, fmt: str = "csv", **options) -> str:
    """Write ``df`` as ONE file at ``target``; an existing target is
    replaced by rename (last writer wins)."""
    spark = df.sparkSession
    tmp = f"{target.rstrip('/')}.tmp-{uuid.uuid4().hex}"
    df.coalesce(1).write.mode("overwrite").format(fmt).options(**options).save(tmp)
    fs, tmp_p = _fs(spark, tmp)
    parts = [s.getPath() for s in fs.listStatus(tmp_p) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise RuntimeError(f"expected one part file in {tmp}, got {len(parts)}")
    _, dst = _fs(spark, target)
    if fs.exists(dst):
        fs.delete(dst, True)
    if not fs.rename(parts[0], dst):
        raise RuntimeError(f"rename to {target} failed")
    fs.delete(tmp_p, True)
    return target


def write_per_key_files(df: DataFrame, key: str, path: str, fmt: str = "csv", **options) -> None:
    """K04 at scale: one file per key value (e.g. one report file per artist).

    Rows are hash-partitioned by ``key`` so each key's rows are written by
    one task into ``path/key=<value>/``; use this only when a key's rows are
    bounded (a per-artist daily report holds at most one row per day)."""
    df.repartition(key).write.mode("overwrite").partitionBy(key).format(fmt).options(**options).save(path)


def report_lines(report: DataFrame) -> DataFrame:
    """K02 layout: artist,plays,day,max_init_plays,pub_day (dates yyyy/MM/dd)."""
    return report.select("artist_id", "plays", "day", "max_init_plays", "pub_day")


def reformat_dates(df: DataFrame, cols, out_fmt: str = "yyyy/MM/dd") -> DataFrame:
    """``yyyyMMdd`` text columns -> ``out_fmt``."""
    for c in cols:
        df = df.withColumn(c, reformat_ymd(c, out_fmt))
    return df


def forecast_lines(forecast: DataFrame) -> DataFrame:
    """K03 layout: artist,floor(prediction),yyyyMMdd."""
    return forecast.select("artist_id", "plays", "ds")


def cache_table(spark: SparkSession, name: str) -> None:
    """Cache a registered table by name."""
    spark.catalog.cacheTable(name)


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Scoped cache (memory, spilling to disk), released on exit."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist(blocking=False)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (survives executor loss)."""
    return df.checkpoint(eager=eager)
