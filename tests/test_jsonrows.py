import datetime
import json

import pytest

from corvid.functions.jsonrows import from_json_row, to_json_row


def test_all_types_and_nulls(spark):
    schema = ("i int, l long, d double, s string, b boolean, dt date, ts timestamp, bin binary, "
              "st struct<x:int,y:string>, arr array<int>, m map<string,double>")
    row = (1, 2, 1.5, None, True, datetime.date(1970, 1, 2), datetime.datetime(1970, 1, 1, 0, 0, 1),
           bytearray(b"\x01\xff"), (3, None), [1, None], {"k": 2.0})
    df = spark.createDataFrame([row], schema)
    obj = json.loads(df.select(to_json_row(df)).first()[0])
    assert obj["s"] is None and "s" in obj
    assert obj["dt"] == 86_400_000 and obj["ts"] == 1000
    assert obj["bin"] == [1, -1]
    assert obj["st"] == {"x": 3, "y": None}
    assert obj["arr"] == [1, None] and obj["m"] == {"k": 2.0}


def test_parse_missing_nullable_is_null(spark):
    df = spark.createDataFrame([('{"a": 1}',)], "j string")
    r = df.select(from_json_row("j", "a int, b string").alias("r")).first().r
    assert r.a == 1 and r.b is None


def test_parse_missing_not_null_raises(spark):
    df = spark.createDataFrame([('{"b": "x"}',)], "j string")
    with pytest.raises(Exception):
        df.select(from_json_row("j", "a int not null, b string").alias("r")).collect()


def test_round_trip_all_types(spark):
    schema = ("i int, d double, s string, dt date, ts timestamp, bin binary, "
              "st struct<x:int,y:string>, arr array<int>, m map<string,double>")
    row = (1, 1.5, None, datetime.date(2015, 3, 1), datetime.datetime(2015, 3, 1, 12, 30, 5),
           bytearray(b"\x01\xff\x00"), (3, None), [1, None], {"k": 2.0})
    df = spark.createDataFrame([row], schema)
    js = df.select(to_json_row(df).alias("j"))
    back = js.select(from_json_row("j", df.schema).alias("r")).select("r.*").first()
    assert tuple(back) == tuple(df.first())


def test_encoding_ignores_session_zone(spark):
    from pyspark.sql import functions as F
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2024-03-10 02:30:00.123456", "2024-03-10")], "t string, d string") \
            .select(F.to_timestamp_ntz("t").alias("t"), F.to_date("d").alias("d"))
        obj = json.loads(df.select(to_json_row(df)).first()[0])
        assert obj["t"] == 1710037800123 and obj["d"] == 1710028800000
        from corvid.functions.dates import calendar_parts
        assert df.select(*calendar_parts("t")).first().hour_of_day == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_round_trip_ntz_and_date_in_other_zone(spark):
    from pyspark.sql import functions as F
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2024-03-10 02:30:00.123", "2024-03-10"), ("1969-12-31 23:59:59.5", "1969-12-31")],
                                   "t string, d string") \
            .select(F.to_timestamp_ntz("t").alias("t"), F.to_date("d").alias("d"))
        js = df.select(to_json_row(df).alias("j"))
        back = js.select(from_json_row("j", df.schema).alias("r")).select("r.*").collect()
        assert [tuple(r) for r in back] == [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
