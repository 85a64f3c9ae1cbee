"""JSON row encoding / decoding queries over events."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.jsonrows import from_json_row, to_json_row
from corvid.plans.registry import query
from corvid.sinks.chunks import result_chunks
from corvid.sources.tables import load_table


def _events(spark, sf):
    e = load_table(spark, sf, "events")
    # a nullable column so the encoder's null handling is exercised
    return e.select("event_id", "ts", "user_id",
                    F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
                    "value", "props")


@query("json_rows", """
SELECT event_id, CAST(to_json({'event_id': event_id, 'ts': epoch_us(ts) // 1000, 'user_id': user_id,
                          'event_type': CASE WHEN event_type <> 'error' THEN event_type END,
                          'value': value, 'props': props}) AS VARCHAR) AS json
FROM events""", ("F16", "K05"))
def q_json_rows(spark, sf):
    e = _events(spark, sf)
    return e.select("event_id", to_json_row(e).alias("json"))


@query("json_parse", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""", ("F17",))
def q_json_parse(spark, sf):
    e = load_table(spark, sf, "events")
    return e.select("event_id", from_json_row("props", "k int").getField("k").alias("k"))


@query("json_roundtrip", """
SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type""",
       ("F16", "F17"))
def q_json_roundtrip(spark, sf):
    e = load_table(spark, sf, "events").select("event_id", "event_type", "value")
    js = e.select(to_json_row(e).alias("j"))
    back = js.select(from_json_row("j", "event_id bigint not null, event_type string, value double")
                     .alias("r")).select("r.*")
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


_SCHEMA = ('{"fields":[' + ",".join(
    f'{{"metadata":{{}},"name":"{name}","nullable":true,"type":"{kind}"}}' for name, kind in (
        ("event_id", "long"), ("ts", "timestamp_ntz"), ("user_id", "long"), ("event_type", "string"), ("value", "double"),
        ("props", "string"))) + '],"type":"struct"}')


def _chunks_sql(where: str, drop: int, take: int | None) -> str:
    upto = f"AND p < {drop + take}" if take is not None else ""
    return f"""
WITH e AS (SELECT *, row_number() OVER (ORDER BY user_id DESC, event_id) - 1 AS p FROM events WHERE {where}),
j AS (SELECT p - {drop} AS p, CAST(to_json({{'event_id': event_id, 'ts': epoch_us(ts) // 1000, 'user_id': user_id,
                          'event_type': CASE WHEN event_type <> 'error' THEN event_type END,
                          'value': value, 'props': props}}) AS VARCHAR) AS json FROM e WHERE p >= {drop} {upto})
SELECT -1::BIGINT AS chunk, count(*) AS rows,
       '{{"schema":{_SCHEMA},"count":' || count(*) || ',"extra":{{"job":"events"}}}}' AS body FROM e
UNION ALL
SELECT CAST(p // 100 AS BIGINT), count(*), '[' || string_agg(json, ',' ORDER BY p) || ']' FROM j GROUP BY 1"""


def _event_chunks(spark, sf, where, drop, take):
    e = _events(spark, sf)
    found = e.filter(where) if where else e
    return result_chunks(found, 100, drop, take, order_by="user_id desc,event_id", extra={"job": "events"})


@query("result_chunks", _chunks_sql("true", 150, 333), ("K05", "K06", "Q03"))
def q_result_chunks(spark, sf):
    """A page of a result: header with schema and full count, then JSON arrays of 100 rows."""
    return _event_chunks(spark, sf, None, 150, 333)


@query("result_chunks_all", _chunks_sql("true", 0, None), ("K05", "K06"))
def q_result_chunks_all(spark, sf):
    return _event_chunks(spark, sf, None, None, None)


@query("result_chunks_empty", _chunks_sql("user_id < 0", 0, None), ("K05", "K06"))
def q_result_chunks_empty(spark, sf):
    """An empty result is a header with count 0."""
    return _event_chunks(spark, sf, "user_id < 0", None, None)
