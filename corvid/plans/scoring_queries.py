"""Scoring single events with an exported linear model, and metrics recomputed from score rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.ml.scoring import LinearModel, flag_below, score_events
from corvid.operators import joins
from corvid.plans.registry import query
from corvid.sources.tables import load_table

# A stated model: probability that an order is finished, from its customer and month.
MODEL = LinearModel({"c_acctbal": 0.000125, "o_totalprice": -0.0000025, "month": 0.0625, "same_region": 0.25}, -0.5)


def _events(spark, sf):
    """Orders as events, enriched through a condition join with the customer's balance and the nation's region."""
    o = load_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.month("o_orderdate").alias("month"))
    c = load_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = load_table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    rows = joins.enrich_where(o, c, (o["o_custkey"] == c["c_custkey"]) & (c["c_acctbal"] > -900))
    rows = joins.enrich_where(rows, n, rows["c_nationkey"] == n["n_nationkey"])
    return rows.withColumn("same_region", (F.col("n_regionkey") == 1).cast("int"))


_EVENTS_SQL = """
WITH e AS (SELECT o_orderkey, o_totalprice, o_orderstatus, month(o_orderdate) AS month, c_acctbal,
                  CASE WHEN n_regionkey = 1 THEN 1 ELSE 0 END AS same_region
           FROM orders JOIN customer ON o_custkey = c_custkey AND c_acctbal > -900 JOIN nation ON c_nationkey = n_nationkey),
s AS (SELECT o_orderkey, o_orderstatus, 1.0 / (1.0 + exp(-(CAST(-0.5 AS DOUBLE) + CAST(0.000125 AS DOUBLE) * c_acctbal
             + CAST(-0.0000025 AS DOUBLE) * o_totalprice + CAST(0.0625 AS DOUBLE) * month + CAST(0.25 AS DOUBLE) * same_region))) AS p
      FROM e)"""


@query("event_scores", _EVENTS_SQL + """
SELECT o_orderkey, round(p, 9) AS p, CASE WHEN round(p, 9) < 0.5 THEN 'low' ELSE 'high' END AS verdict FROM s""", ("M16", "J10", "F20", "M18"))
def q_event_scores(spark, sf):
    scored = score_events(_events(spark, sf), MODEL).withColumn("p", F.round("p", 9))
    return scored.select("o_orderkey", "p", flag_below("p", 0.5, "low", "high").alias("verdict"))


@query("event_score_table", _EVENTS_SQL + """
SELECT CAST(floor(round(p, 9) * 20) AS INTEGER) AS band, count(*) AS events, count(*) FILTER (WHERE o_orderstatus = 'F') AS hits,
       count(*) FILTER (WHERE (round(p, 9) >= 0.5) = (o_orderstatus = 'F')) AS correct FROM s GROUP BY 1""", ("M16", "M08", "M15"))
def q_event_score_table(spark, sf):
    """Events and hits per score band of a twentieth, and how many the threshold calls right."""
    scored = score_events(_events(spark, sf), MODEL).withColumn("p", F.round("p", 9))
    hit = F.col("o_orderstatus") == "F"
    return (scored.groupBy(F.floor(F.col("p") * 20).cast("int").alias("band"))
            .agg(F.count(F.lit(1)).alias("events"), F.count_if(hit).alias("hits"),
                 F.count_if((F.col("p") >= 0.5) == hit).alias("correct")))
