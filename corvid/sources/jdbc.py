"""JDBC reads.

* ``fetch``: a query as a table; date/timestamp columns become strings.
* ``fetch_partitioned``: range-partitioned read.  Spark's bounds only set
  the strides, so the reference's inclusive ``[lower, upper]`` row filter is
  added explicitly (it is pushed to the database).  Column names are
  lower-cased.
* ``lookup_ids``: one id column where another column is in a list; an SQL
  error gives an empty result, as in the reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def jdbc_options(url: str, table: str | None = None, query: str | None = None,
                 user: str | None = None, password: str | None = None,
                 driver: str | None = None, **extra) -> dict:
    opts = {"url": url}
    if query is not None:
        opts["query"] = query
    if table is not None:
        opts["dbtable"] = table
    for k, v in (("user", user), ("password", password), ("driver", driver)):
        if v is not None:
            opts[k] = v
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def dates_as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name)
                       if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def fetch(spark: SparkSession, url: str, query: str, **kw) -> DataFrame:
    """S14."""
    return dates_as_text(spark.read.format("jdbc").options(**jdbc_options(url, query=query, **kw)).load())


def fetch_partitioned(spark: SparkSession, url: str, table: str, column: str,
                      lower: int = 0, upper: int = 2**31 - 1, partitions: int = 1, **kw) -> DataFrame:
    """``partitions`` range reads over ``column``; rows outside
    ``[lower, upper]`` are filtered out (pushed down)."""
    opts = jdbc_options(url, table=table, partitionColumn=column, lowerBound=lower,
                        upperBound=upper, numPartitions=partitions, **kw)
    df = spark.read.format("jdbc").options(**opts).load()
    df = df.filter(F.col(column).between(lower, upper))
    return dates_as_text(df.toDF(*[c.lower() for c in df.columns]))


def lookup_ids(spark: SparkSession, url: str, table: str, id_col: str, key_col: str, keys,
               **kw) -> DataFrame:
    """S16."""
    try:
        df = spark.read.format("jdbc").options(**jdbc_options(url, table=table, **kw)).load()
        out = df.filter(F.col(key_col).isin(list(keys))).select(id_col)
        out.schema  # noqa: B018 -- forces analysis so a bad table/column errors here
        return out
    except Exception:  # noqa: BLE001
        return spark.createDataFrame([], T.StructType([T.StructField(id_col, T.StringType())]))
