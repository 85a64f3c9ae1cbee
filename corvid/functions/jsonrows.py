"""Rows <-> JSON objects, as column expressions.

Encoding writes nulls (``ignoreNullFields=false``), dates and timestamps as
epoch milliseconds and binary as a list of signed byte numbers, like the
reference's row encoder.  Decoding parses by a schema with FAILFAST and
raises when a NOT NULL field is missing or null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _bytes_list(c: Column) -> Column:
    n = F.octet_length(c)
    idx = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    vals = F.transform(idx, lambda i: F.conv(F.hex(F.substring(c, i, 1)), 16, 10).cast("int"))
    signed = F.transform(vals, lambda v: F.when(v > 127, v - 256).otherwise(v))
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(signed)


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("date")


def _epoch_ms_local(c: Column) -> Column:
    """Epoch ms of a wall-clock (timestamp_ntz) value, independent of the
    session time zone (a cast to timestamp would apply the zone, and shift
    wall times that fall in a daylight-saving gap)."""
    day_ms = F.datediff(F.to_date(c), _epoch()).cast("long") * F.lit(86_400_000)
    sec = F.date_part(F.lit("SECOND"), c)  # seconds with micro fraction
    ms_in_day = (F.hour(c).cast("long") * 3_600_000 + F.minute(c).cast("long") * 60_000
                 + F.floor(sec * 1000).cast("long"))
    return day_ms + ms_in_day


def _encodable(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.DateType):
        # midnight UTC of the day, whatever the session zone
        return F.datediff(c, _epoch()).cast("long") * F.lit(86_400_000)
    if isinstance(dt, T.TimestampType):
        return F.unix_millis(c)
    if isinstance(dt, T.TimestampNTZType):
        return _epoch_ms_local(c)
    if isinstance(dt, T.BinaryType):
        return _bytes_list(c)
    if isinstance(dt, T.StructType):
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(*[_encodable(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _encodable(x, dt.elementType))
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda k, v: _encodable(v, dt.valueType))
    return c


def to_json_row(df: DataFrame, cols=None) -> Column:
    """F16: one JSON object per row over ``cols`` (default: all columns)."""
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    st = F.struct(*[_encodable(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields])
    return F.to_json(st, {"ignoreNullFields": "false"})


def _wire_type(dt: T.DataType) -> T.DataType:
    """The JSON-side type: dates/timestamps are epoch ms, binary is a byte list."""
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return T.LongType()
    if isinstance(dt, T.BinaryType):
        return T.ArrayType(T.IntegerType())
    if isinstance(dt, T.StructType):
        return T.StructType([T.StructField(f.name, _wire_type(f.dataType), True) for f in dt.fields])
    if isinstance(dt, T.ArrayType):
        return T.ArrayType(_wire_type(dt.elementType), True)
    if isinstance(dt, T.MapType):
        return T.MapType(T.StringType(), _wire_type(dt.valueType), True)
    return dt


def _day_of(ms: Column) -> Column:
    return F.date_add(_epoch(), F.floor(ms / F.lit(86_400_000)).cast("int"))


def _local_from_ms(ms: Column) -> Column:
    """Epoch ms -> timestamp_ntz (wall clock at UTC), session-zone free."""
    d = _day_of(ms)
    rem = ms - F.floor(ms / F.lit(86_400_000)) * F.lit(86_400_000)
    secs = F.pmod(rem, F.lit(60_000)).cast("decimal(12,3)") / F.lit(1000)
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                F.floor(rem / F.lit(3_600_000)).cast("int"),
                                F.floor(F.pmod(rem, F.lit(3_600_000)) / F.lit(60_000)).cast("int"),
                                secs.cast("decimal(16,6)"))


def _from_wire(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.DateType):
        return _day_of(c)
    if isinstance(dt, T.TimestampType):
        return F.timestamp_millis(c)
    if isinstance(dt, T.TimestampNTZType):
        return _local_from_ms(c)
    if isinstance(dt, T.BinaryType):
        hexes = F.transform(c, lambda x: F.lpad(F.hex(F.pmod(x, F.lit(256))), 2, "0"))
        return F.unhex(F.array_join(hexes, ""))
    if isinstance(dt, T.StructType):
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(*[_from_wire(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _from_wire(x, dt.elementType))
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda k, v: _from_wire(v, dt.valueType))
    return c


def from_json_row(c, schema: T.StructType | str, strict: bool = True) -> Column:
    """JSON object -> struct by ``schema`` (the inverse of
    :func:`to_json_row`: epoch ms -> date/timestamp, byte lists -> binary).
    A missing field is null when nullable, otherwise an error -- checked
    explicitly, since Spark itself would silently give null."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    col = F.col(c) if isinstance(c, str) else c
    parsed = F.from_json(col, _wire_type(schema), {"mode": "FAILFAST"} if strict else {})
    out = F.struct(*[_from_wire(parsed[f.name], f.dataType).alias(f.name) for f in schema.fields])
    required = [f.name for f in schema.fields if not f.nullable]
    if not required:
        return out
    bad = None
    for name in required:
        cond = parsed[name].isNull()
        bad = cond if bad is None else (bad | cond)
    return F.when(col.isNotNull() & bad,
                  F.raise_error(F.concat(F.lit("missing NOT NULL field in: "), col))).otherwise(out)
