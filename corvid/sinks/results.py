"""Result documents for a client.

``iter_json_rows`` streams JSON rows partition by partition
(``toLocalIterator``), so the driver holds one partition at a time, never
the whole result.  ``result_document`` applies drop/take lazily on the
ordered frame and counts rows before drop/take in a separate job, like the
reference.  ``write_result_document`` writes the rows as JSON lines from the
executors plus one small header record, for results of any size.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame

from corvid.functions.jsonrows import to_json_row


def iter_json_rows(df: DataFrame):
    """JSON text per row, one partition at a time."""
    for r in df.select(to_json_row(df).alias("j")).toLocalIterator(prefetchPartitions=True):
        yield r["j"]


def iter_json_chunks(df: DataFrame, size: int = 100):
    """JSON rows in chunks of ``size`` (the reference sent groups of 100)."""
    chunk = []
    for j in iter_json_rows(df):
        chunk.append(j)
        if len(chunk) == size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def result_document(df: DataFrame, drop: int | None = None, take: int | None = None,
                    order_by: str | None = None, extra: dict | None = None) -> dict:
    """``{schema, rows, count, extra}``; ``count`` = rows before drop/take.

    Paging needs an order: ``order_by`` (``"a,b desc"``) or, if absent, the
    whole row.  ``rows`` is a lazy iterator that holds one partition at a time.
    """
    from corvid.operators.shape import parse_order_spec, whole_row
    page = df
    if drop is not None or take is not None:
        page = df.orderBy(*(parse_order_spec(df, order_by) if order_by else [whole_row(df)]))
        if drop:
            page = page.offset(drop)
        if take is not None:
            page = page.limit(take)
    count = df.count()
    rows = (json.loads(j) for j in iter_json_rows(page))
    return {"schema": json.loads(df.schema.json()), "rows": rows, "count": count, "extra": extra or {}}


def write_result_document(df: DataFrame, path: str, extra: dict | None = None) -> None:
    """K05 at scale: ``path/rows`` JSON lines + ``path/header`` record."""
    df.select(to_json_row(df).alias("value")).write.mode("overwrite").text(f"{path}/rows")
    spark = df.sparkSession
    header = {"schema": json.loads(df.schema.json()), "count": df.count(), "extra": extra or {}}
    spark.createDataFrame([(json.dumps(header),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/header")
