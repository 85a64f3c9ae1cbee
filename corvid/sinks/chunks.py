"""K05 / K06 at any size: a result as one header row and JSON arrays of ``size`` rows.

Rows are numbered by :func:`corvid.operators.positions.with_positions` (counts per
partition, no global window); drop and take are ranges of positions, a chunk is the
positions divided by ``size``.  A chunk holds at most ``size`` rows, so a grouped
list of it is bounded; chunks are written by the executors.

Defined cases: an empty result has a header with count 0 and no chunk; ``count`` is
taken before drop and take; rows that tie on the order may swap places, so the order
should decide (without one it is the whole row's JSON text); nulls are written as null.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.functions.jsonrows import to_json_row
from corvid.operators.positions import with_positions
from corvid.operators.shape import parse_order_spec, whole_row

HEADER = -1
_ROW = "__row"


def result_chunks(df: DataFrame, size: int = 100, drop: int | None = None, take: int | None = None,
                  order_by: str | None = None, extra: dict | None = None) -> DataFrame:
    """``chunk, rows, body``: chunk -1 is the header ``{schema, count, extra}``, chunk i holds rows i * size onwards."""
    spark = df.sparkSession
    encoded = df.withColumn(_ROW, to_json_row(df))
    order = parse_order_spec(df, order_by) if order_by else [whole_row(df)]
    placed = with_positions(encoded, *order, col="__position").select(_ROW, "__position")
    first = drop or 0
    page = placed.filter(F.col("__position") >= first)
    if take is not None:
        page = page.filter(F.col("__position") < first + take)
    page = page.withColumn("__position", F.col("__position") - first)
    chunks = (page.groupBy(F.expr(f"__position div {size}").alias("chunk"))
              .agg(F.count(F.lit(1)).alias("rows"), F.sort_array(F.collect_list(F.struct("__position", _ROW))).alias("__held"))
              .select("chunk", "rows", F.concat(F.lit("["), F.array_join(F.transform("__held", lambda r: r[_ROW]), ","), F.lit("]"))
                      .alias("body")))
    schema = json.dumps(json.loads(df.schema.json()), separators=(",", ":"))
    tail = f',"extra":{json.dumps(extra or {}, separators=(",", ":"), sort_keys=True)}}}'
    header = placed.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(HEADER).cast("long").alias("chunk"), "rows",
        F.concat(F.lit(f'{{"schema":{schema},"count":'), F.col("rows").cast("string"), F.lit(tail)).alias("body"))
    return header.unionByName(chunks)


def write_chunks(df: DataFrame, path: str, **shape) -> None:
    """One JSON text per line under ``path/header`` and ``path/chunks``; the chunks in order of their numbers."""
    every = result_chunks(df, **shape)
    every.filter(F.col("chunk") == HEADER).select(F.col("body").alias("value")).write.mode("overwrite").text(f"{path}/header")
    (every.filter(F.col("chunk") != HEADER).orderBy("chunk").select(F.col("body").alias("value"))
     .write.mode("overwrite").text(f"{path}/chunks"))
