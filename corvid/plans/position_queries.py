"""Pairing by position over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.operators.positions import pair_by_position, with_positions
from corvid.plans.registry import query
from corvid.sources.tables import load_table


@query("row_positions", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS position FROM orders""", ("J11",))
def q_row_positions(spark, sf):
    o = load_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return with_positions(o, F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "position")


@query("pair_by_position", """
WITH a AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders),
b AS (SELECT o_orderkey AS cheaper_key, o_totalprice AS cheaper_price,
             row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position FROM orders)
SELECT position, o_orderkey, o_totalprice, cheaper_key, cheaper_price FROM a JOIN b USING (position)""", ("J11",))
def q_pair_by_position(spark, sf):
    """Orders by date beside orders by price: the i-th of one with the i-th of the other."""
    o = load_table(spark, sf, "orders")
    by_date = o.select("o_orderkey", "o_totalprice", "o_orderdate")
    by_price = o.select(F.col("o_orderkey").alias("cheaper_key"), F.col("o_totalprice").alias("cheaper_price"))
    pairs = pair_by_position(by_date, by_price, ("o_orderdate", "o_orderkey"), ("cheaper_price", "cheaper_key"))
    return pairs.select("position", "o_orderkey", "o_totalprice", "cheaper_key", "cheaper_price")
