"""Companion queries: the part of a model, a cache or a printed answer that SQL can check."""

from __future__ import annotations

import json

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corvid.functions.text import MESSAGE_IGNORED_CHARS, MESSAGE_IGNORED_WORDS
from corvid.ml import models as ml
from corvid.ml.lloyd import assign, lloyd
from corvid.operators import shape, text
from corvid.plans.registry import query
from corvid.plans.scoring_queries import _EVENTS_SQL, MODEL, _events
from corvid.plans.sqltext import jsplit, str_list
from corvid.sinks.files import cached
from corvid.sources.tables import load_table

DIM = 64
_CHARS = "".join(MESSAGE_IGNORED_CHARS).replace("'", "''")


@query("term_frequency_sums", f"""
WITH m AS (SELECT conv_id, turn,
                  {jsplit(f"translate(lower(text), '{_CHARS}', '{' ' * len(MESSAGE_IGNORED_CHARS)}')", ' ', ' +$')} AS arr
           FROM conversations),
f AS (SELECT conv_id, turn, list_filter(arr, lambda x: NOT list_contains({str_list(MESSAGE_IGNORED_WORDS)}, x)
                                                   AND length(x) + length(regexp_replace(x, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) >= 3) AS arr FROM m)
SELECT conv_id, turn, CAST(len(list_distinct(arr)) AS DOUBLE) AS total FROM f""", ("M17", "M22"))
def q_term_frequency_sums(spark, sf):
    """What the hashed term frequencies of a message add up to: its number of tokens, whatever falls together."""
    toks = text.message_tokens(load_table(spark, sf, "conversations"), "text", keep=("conv_id", "turn"))
    _, feats = ml.tfidf(toks)
    total = F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, x: a + x)
    return feats.select("conv_id", "turn", total.alias("total"))


def _steps_sql(steps: int) -> str:
    """Lloyd steps from the vectors 0 and 1 as common table expressions."""
    def dist(c):
        return "(" + " + ".join(f"(v[{i + 1}] - {c}[{i + 1}]) * (v[{i + 1}] - {c}[{i + 1}])" for i in range(DIM)) + ")"
    means = "[" + ", ".join(f"avg(v[{i + 1}])" for i in range(DIM)) + "]"
    out = ["WITH e AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings)",
           "c0 AS MATERIALIZED (SELECT (SELECT v FROM e WHERE vec_id = 0) AS a, (SELECT v FROM e WHERE vec_id = 1) AS b)"]
    for s in range(steps):
        out.append(f"n{s} AS (SELECT vec_id, v, CASE WHEN {dist('b')} < {dist('a')} THEN 1 ELSE 0 END AS cluster, "
                   f"least({dist('a')}, {dist('b')}) AS d2 FROM e, c{s})")
        out.append(f"c{s + 1} AS MATERIALIZED (SELECT (SELECT {means} FROM n{s} WHERE cluster = 0) AS a, (SELECT {means} FROM n{s} WHERE cluster = 1) AS b)")
    out.append(f"last AS (SELECT vec_id, CASE WHEN {dist('b')} < {dist('a')} THEN 1 ELSE 0 END AS cluster, "
               f"least({dist('a')}, {dist('b')}) AS d2 FROM e, c{steps})")
    return ",\n".join(out)


@query("lloyd_steps", _steps_sql(3) + "\nSELECT vec_id, CAST(cluster AS INTEGER) AS cluster, round(d2, 4) AS d2 FROM last", ("M05",))
def q_lloyd_steps(spark, sf):
    """Clusters after three Lloyd steps from two given vectors."""
    e = load_table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double")).alias("v"))
    first = {r["vec_id"]: r["v"] for r in e.filter("vec_id in (0, 1)").collect()}
    centres, _ = lloyd(e, "v", [first[0], first[1]], 3)
    near = assign(e, "v", centres)
    return near.select("vec_id", "cluster", F.round("cluster_d2", 4).alias("d2"))


@query("holdout_rmse", """
WITH r AS (SELECT l_quantity AS x, l_extendedprice AS y,
                  ('0x' || substr(md5(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) || '|0'), 1, 8))::BIGINT % 100 < 80 AS train FROM lineitem),
f AS (SELECT regr_slope(y, x) AS s, regr_intercept(y, x) AS i FROM r WHERE train)
SELECT round(s, 4) AS slope, round(i, 2) AS intercept, round((SELECT sqrt(avg((y - (s * x + i)) ** 2)) FROM r WHERE NOT train), 3) AS rmse
FROM f""", ("M02", "M14"))
def q_holdout_rmse(spark, sf):
    """A line fitted on the training split, its error on the rest."""
    li = load_table(spark, sf, "lineitem")
    data = ml.assemble(li.select(F.col("l_extendedprice").alias("label"), "l_quantity",
                                 (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_key")), ["l_quantity"])
    train, test = ml.hash_split(data, "_key", 80)
    m, _ = ml.linear_regression(train, reg=0.0, elastic_net=0.0, solver="normal")
    return spark.range(1).select(F.round(F.lit(float(m.coefficients[0])), 4).alias("slope"), F.round(F.lit(float(m.intercept)), 2).alias("intercept"),
                                 F.round(F.lit(float(ml.rmse(m.transform(test)))), 3).alias("rmse"))


@query("event_auc", _EVENTS_SQL + """,
k AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
             rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS rk
      FROM (SELECT o_orderstatus, round(p, 9) AS p FROM s))
SELECT round((sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 7) AS auc,
       round((SELECT sum(greatest(0, 1 - (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE -1 END) * ln(p / (1 - p)))) / count(*) FROM s), 6) AS hinge
FROM k""", ("M15", "M09"))
def q_event_auc(spark, sf):
    """Area under ROC and mean hinge loss of a stated linear model's scores."""
    rows = _events(spark, sf).withColumn("margin", MODEL.margin()).withColumn("p", F.round(MODEL.probability(), 9))
    hit = F.col("o_orderstatus") == "F"
    auc = ml.BinaryClassificationEvaluator(rawPredictionCol="p", numBins=0).evaluate(rows.withColumn("label", hit.cast("double")))
    loss = F.greatest(F.lit(0.0), 1 - F.when(hit, 1).otherwise(-1) * F.col("margin"))
    return rows.agg(F.round(F.avg(loss), 6).alias("hinge")).select(F.round(F.lit(float(auc)), 7).alias("auc"), "hinge")


@query("gbt_score_table", None, ("M12",))
def q_gbt_score_table(spark, sf):
    """Mean squared error of boosted trees by number of trees, on training rows and on a validation frame."""
    o = load_table(spark, sf, "orders")
    rows = o.select("o_orderkey", F.col("o_totalprice").alias("label"), F.month("o_orderdate").cast("double").alias("month"),
                    F.year("o_orderdate").cast("double").alias("year"), (F.col("o_custkey") % 100).cast("double").alias("group"))
    train, valid = ml.hash_split(ml.assemble(rows, ["month", "year", "group"]), "o_orderkey", 80)
    return ml.gbt_score_table(train, valid)


@query("schema_text", """
SELECT column_name AS name, row_number() OVER () - 1 AS position FROM (DESCRIBE SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders)""", ("Q03",))
def q_schema_text(spark, sf):
    """The fields that the schema's JSON text names."""
    o = shape.shape(load_table(spark, sf, "orders"), select="o_orderkey,o_totalprice,o_orderstatus")
    fields = json.loads(shape.schema_json(o))["fields"]
    return spark.createDataFrame([(f["name"], i) for i, f in enumerate(fields)], "name string, position long")


@query("explain_scan", "SELECT true AS reads_orders, true AS filters, 2 AS columns_read, count(*) AS n FROM orders WHERE o_orderstatus = 'F'", ("Q04",))
def q_explain_scan(spark, sf):
    """What the plan text says: the table it reads, the pushed filter, the pruned columns; and the rows it gives."""
    df = load_table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    plan = shape.explain_text(df)
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    return df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("orders.parquet" in plan).alias("reads_orders"), F.lit("EqualTo(o_orderstatus,F)" in plan).alias("filters"),
        F.lit(read.count(":") - 1).alias("columns_read"), "n")


@query("show_rows", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, count(*) OVER () AS total FROM
(SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20)""", ("Q05",))
def q_show_rows(spark, sf):
    """The rows that the printed answer shows (20, as it is meant to)."""
    shown = shape.show_text(load_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").orderBy("o_orderkey"), 20)
    cells = [[c.strip() for c in line.strip("|").split("|")] for line in shown.splitlines() if line.startswith("|")]
    rows = [c for c in cells[1:] if not c[0].startswith("--")]
    return spark.createDataFrame([(k, s, len(rows)) for k, s in rows], "o_orderkey string, o_orderstatus string, total long")


@query("cache_scope", "SELECT count(*) AS n, true AS held, false AS after FROM orders WHERE o_orderstatus = 'F'", ("K08",))
def q_cache_scope(spark, sf):
    """A scoped cache: stored while the scope is open, released after it."""
    df = load_table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    with cached(df):
        n, held = df.count(), df.storageLevel.useMemory
    return spark.createDataFrame([(n, held, df.storageLevel.useMemory)], "n long, held boolean, after boolean")


@query("row_map", """
SELECT c_custkey, upper(c_mktsegment) || '#' || CAST(c_nationkey AS VARCHAR) AS tag,
       CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS class,
       round(c_acctbal * 2 + 1, 2) AS moved FROM customer""", ("U03",))
def q_row_map(spark, sf):
    """Row to row functions as column expressions."""
    c = load_table(spark, sf, "customer")
    return c.select("c_custkey", F.concat(F.upper("c_mktsegment"), F.lit("#"), F.col("c_nationkey").cast("string")).alias("tag"),
                    F.when(F.col("c_acctbal") < 0, "debt").when(F.col("c_acctbal") < 5000, "low").otherwise("high").alias("class"),
                    F.round(F.col("c_acctbal") * 2 + 1, 2).alias("moved"))
