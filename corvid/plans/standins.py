"""Stand-in views: the reference's input layouts derived from the test tables.

songs   <- part     : song = part, artist = brand (all text, as in the reference)
actions <- lineitem : song = part key, action = return flag, day = ship date

Each view is a pure projection, so Catalyst prunes columns and the scan
reads only what the job needs.  The matching DuckDB text is kept next to
each view so the oracle SQL builds the same inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Return flag -> action type (N = play, A = download, R = favour).
ACTION_OF_FLAG = {"N": "1", "A": "2", "R": "3"}
# Day numbers count from this day (first ship dates are in early 1995).
ORIGIN = "1995-01-01"
# Publish-age buckets are measured to this day.
PUB_REFERENCE = "2002-01-01"


def songs_view(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("song_id"),
        F.col("p_brand").alias("artist_id"),
        F.date_format(F.date_add(F.lit("1994-01-01").cast("date"), F.col("p_size") * 7),
                      "yyyyMMdd").alias("publish_time"),
        F.col("p_retailprice").cast("long").cast("string").alias("song_init_plays"),
        (F.col("p_size") % 5).cast("string").alias("Language"),
        (F.col("p_size") % 3 + 1).cast("string").alias("Gender"))


def actions_view(lineitem: DataFrame, text_days: bool = True) -> DataFrame:
    """``Ds`` as yyyyMMdd text, the reference's layout, or as the date it is made from."""
    day = F.to_date("l_shipdate")
    flag = F.col("l_returnflag")
    action = F.when(flag == "N", "1").when(flag == "A", "2").when(flag == "R", "3")
    return lineitem.select(
        F.col("l_orderkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("song_id"),
        F.col("l_linenumber").cast("string").alias("gmt_create"),
        action.alias("action_type"),
        (F.date_format(day, "yyyyMMdd") if text_days else day).alias("Ds"))


SONGS_SQL = """
  SELECT CAST(p_partkey AS VARCHAR) AS song_id, p_brand AS artist_id,
         strftime(DATE '1994-01-01' + CAST(p_size * 7 AS INTEGER), '%Y%m%d') AS publish_time,
         CAST(CAST(trunc(p_retailprice) AS BIGINT) AS VARCHAR) AS song_init_plays,
         CAST(p_size % 5 AS VARCHAR) AS Language,
         CAST(p_size % 3 + 1 AS VARCHAR) AS Gender
  FROM part"""

ACTIONS_SQL = """
  SELECT CAST(l_orderkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS song_id,
         CAST(l_linenumber AS VARCHAR) AS gmt_create,
         CASE l_returnflag WHEN 'N' THEN '1' WHEN 'A' THEN '2' WHEN 'R' THEN '3' END AS action_type,
         strftime(l_shipdate, '%Y%m%d') AS Ds
  FROM lineitem"""
