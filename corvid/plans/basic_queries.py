"""Projection, filter, group, join, rate, date and shaping queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.dates import age_bucket, calendar_parts, parse_local_timestamp
from corvid.functions.strings import eq_number, eq_optional, text_is_true, uri_component
from corvid.operators import dims, joins, rates, shape
from corvid.plans.registry import query
from corvid.plans.standins import SONGS_SQL, songs_view
from corvid.sources.files import clean_names, drop_position
from corvid.sources.tables import load_table, register_tables


def T(spark, sf, name):
    return load_table(spark, sf, name)


@query("project_filter", """
SELECT l_orderkey, l_linenumber, l_quantity + 1 AS qty_plus_one
FROM lineitem WHERE l_quantity > 21""", ("P01", "P02", "P03"))
def q_project_filter(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.filter(F.col("l_quantity") > 21).select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") + 1).alias("qty_plus_one"))


@query("group_count", """
SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus""",
       ("A02",))
def q_group_count(spark, sf):
    return T(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus") \
        .agg(F.count(F.lit(1)).alias("n"))


@query("global_aggs", f"""
WITH songs AS ({SONGS_SQL})
SELECT count(*) AS n_rows, sum(CAST(Language AS DOUBLE)) AS sum_language,
       sum(CAST(Gender AS DOUBLE)) AS sum_gender FROM songs""", ("A01", "A04"))
def q_global_aggs(spark, sf):
    songs = songs_view(T(spark, sf, "part"))
    # Sums over text columns, read as numbers (bad text raises under ANSI).
    return songs.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.sum(F.col("Language").cast("double")).alias("sum_language"),
                     F.sum(F.col("Gender").cast("double")).alias("sum_gender"))


@query("like_filter", """
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE c_name LIKE '%0001%' AND c_mktsegment = 'BUILDING'""", ("P06",))
def q_like_filter(spark, sf):
    c = T(spark, sf, "customer")
    return c.filter(F.col("c_name").like("%0001%") & (F.col("c_mktsegment") == "BUILDING")) \
        .select("c_custkey", "c_name", "c_mktsegment")


@query("join_three_keys", """
WITH s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
                  CAST(day(l_shipdate) AS INTEGER) AS day, count(*) AS n_lines, sum(l_quantity) AS qty
           FROM lineitem GROUP BY 1, 2, 3)
SELECT o.o_orderkey, s.year, s.month, s.day, s.n_lines, round(s.qty, 4) AS qty
FROM orders o JOIN s ON CAST(year(o.o_orderdate) AS INTEGER) = s.year
  AND CAST(month(o.o_orderdate) AS INTEGER) = s.month AND CAST(day(o.o_orderdate) AS INTEGER) = s.day""",
       ("J04",))
def q_join_three_keys(spark, sf):
    li, o = T(spark, sf, "lineitem"), T(spark, sf, "orders")
    ship = (li.groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"),
                       F.dayofmonth("l_shipdate").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty")))
    od = o.select("o_orderkey", F.year("o_orderdate").alias("year"),
                  F.month("o_orderdate").alias("month"), F.dayofmonth("o_orderdate").alias("day"))
    out = joins.join_on_keys(od, ship, ["year", "month", "day"])
    return out.select("o_orderkey", "year", "month", "day", "n_lines", F.round("qty", 4).alias("qty"))


@query("join_three_tables", """
SELECT o.o_orderkey, c.c_name, n.n_name, o.o_totalprice
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey""", ("J05",))
def q_join_three_tables(spark, sf):
    o, c, n = T(spark, sf, "orders"), T(spark, sf, "customer"), T(spark, sf, "nation")
    out = joins.enrich(
        o.select("o_orderkey", "o_custkey", "o_totalprice"),
        [(c.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey"), "o_custkey"),
         (n.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")])
    return out.select("o_orderkey", "c_name", "n_name", "o_totalprice")


@query("cross_enrich", """
SELECT n_nationkey, n_name, r_name FROM nation, region WHERE n_regionkey = r_regionkey""", ("J10",))
def q_cross_enrich(spark, sf):
    n, r = T(spark, sf, "nation"), T(spark, sf, "region")
    return joins.enrich_where(n, r, n["n_regionkey"] == r["r_regionkey"]) \
        .select("n_nationkey", "n_name", "r_name")


@query("rate_table", """
WITH per AS (SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS num_flagged,
                    count(*) AS num_rows FROM orders GROUP BY o_orderpriority),
     tot AS (SELECT sum(num_flagged) AS af, sum(num_rows) AS ar FROM per)
SELECT o_orderpriority, round(num_flagged / num_rows, 6) AS rate, num_flagged, num_rows,
       round(num_flagged / af, 6) AS flagged_to_all_flagged,
       round(num_flagged / ar, 6) AS flagged_to_all_rows,
       round(num_rows / ar, 6) AS rows_to_all_rows
FROM per, tot WHERE num_flagged > 0 AND o_orderpriority IS NOT NULL""", ("A07", "A09", "O02"))
def q_rate_table(spark, sf):
    o = T(spark, sf, "orders")
    out = rates.rate_table(o, "o_orderpriority", F.col("o_orderstatus") == "F")
    return out.select("o_orderpriority", F.round("rate", 6).alias("rate"), "num_flagged", "num_rows",
                      *[F.round(c, 6).alias(c) for c in
                        ("flagged_to_all_flagged", "flagged_to_all_rows", "rows_to_all_rows")])


@query("date_parts", """
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
       CAST(day(ts) AS INTEGER) AS day, CAST(weekofyear(ts) AS INTEGER) AS week_num,
       CAST(hour(ts) AS INTEGER) AS hour_of_day,
       CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
       CAST((month(ts) % 12) // 3 + 1 AS INTEGER) AS season,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS week_day
FROM events""", ("F18",))
def q_date_parts(spark, sf):
    e = T(spark, sf, "events")
    return e.select("event_id", *calendar_parts("ts"))


@query("publish_age_bucket", """
SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-01-01') AS INTEGER) AS age_days,
       CAST(trunc(date_diff('day', CAST(o_orderdate AS DATE), DATE '1999-01-01') / 90) AS BIGINT) AS age_bucket
FROM orders""", ("F12",))
def q_publish_age_bucket(spark, sf):
    o = T(spark, sf, "orders")
    return o.select("o_orderkey",
                    F.datediff(F.lit("1999-01-01").cast("date"), F.to_date("o_orderdate")).alias("age_days"),
                    age_bucket("o_orderdate", "1999-01-01", 90, fmt=None).alias("age_bucket"))


# ---- Q02 shaping on orders -------------------------------------------------
_SHAPE = dict(filter="o_totalprice > 100000 and o_orderstatus = 'F'",
              select="o_orderkey,o_custkey,o_totalprice,o_orderpriority",
              order_by="o_totalprice desc,o_orderkey", limit=100)
_SHAPE_SQL = """SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
WHERE o_totalprice > 100000 AND o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"""


@query("shape_full", _SHAPE_SQL, ("Q02", "O03", "O04", "P10"))
def q_shape_full(spark, sf):
    return shape.shape(T(spark, sf, "orders"), **_SHAPE)


@query("shape_page", f"""
SELECT * FROM ({_SHAPE_SQL}) t ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 10""",
       ("O05",))
def q_shape_page(spark, sf):
    return shape.shape(T(spark, sf, "orders"), drop=10, take=20, **_SHAPE)


@query("shape_count", """
SELECT count(*) AS count FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'""", ("A01", "Q02"))
def q_shape_count(spark, sf):
    kw = dict(_SHAPE)
    kw.pop("limit")
    return shape.shaped_count(T(spark, sf, "orders"), drop=5, take=5, **kw)


@query("shape_distinct", """
SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders""", ("A10",))
def q_shape_distinct(spark, sf):
    return shape.shape(T(spark, sf, "orders"), select="o_orderstatus,o_orderpriority", distinct=True,
                       order_by="o_orderpriority,o_orderstatus desc")


@query("sql_text", """
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderpriority HAVING count(*) > 10""", ("Q01", "S18"))
def q_sql_text(spark, sf):
    register_tables(spark, sf, ["orders"])
    df = shape.run_sql(spark, "SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total "
                              "FROM orders GROUP BY o_orderpriority")
    return shape.shape(df, filter="n > 10", order_by="n desc")


# ---- J06-J08 / P09 dimension filters ----------------------------------------
_DIM_COLS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
_DIM_SELECT = "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem"


@query("dim_filter_one", _DIM_SELECT + " WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45)",
       ("J06",))
def q_dim_filter_one(spark, sf):
    part = T(spark, sf, "part").filter(F.col("p_size") > 45).select(F.col("p_partkey").alias("l_partkey"))
    return dims.filter_dimension(T(spark, sf, "lineitem"), part, "l_partkey").select(*_DIM_COLS)


@query("dim_filter_pair", _DIM_SELECT + """ li WHERE EXISTS (SELECT 1 FROM lineitem k
  WHERE k.l_returnflag = 'R' AND k.l_quantity >= 48 AND k.l_partkey = li.l_partkey AND k.l_suppkey = li.l_suppkey)""",
       ("J07",))
def q_dim_filter_pair(spark, sf):
    li = T(spark, sf, "lineitem")
    pairs = li.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 48)) \
        .select("l_partkey", "l_suppkey")
    return dims.filter_dimension_pairs(li, pairs, "l_partkey", "l_suppkey").select(*_DIM_COLS)


_SMALL_DIM = "SELECT s_suppkey FROM supplier WHERE s_nationkey = 7"
_LARGE_DIM = "SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000"


@query("dim_filter_small", _DIM_SELECT + f" WHERE l_suppkey IN ({_SMALL_DIM})", ("J06", "J08"))
def q_dim_filter_small(spark, sf):
    keys = T(spark, sf, "supplier").filter(F.col("s_nationkey") == 7).select(F.col("s_suppkey").alias("l_suppkey"))
    return dims.filter_products(T(spark, sf, "lineitem"), keys, name="l_suppkey").select(*_DIM_COLS)


@query("dim_filter_list", _DIM_SELECT + f" WHERE l_suppkey IN ({_LARGE_DIM})", ("J06",))
def q_dim_filter_list(spark, sf):
    keys = T(spark, sf, "supplier").filter(F.col("s_acctbal") > 5000).select(F.col("s_suppkey").alias("l_suppkey"))
    return dims.filter_dimension(T(spark, sf, "lineitem"), keys, "l_suppkey").select(*_DIM_COLS)


@query("dim_filter_empty", _DIM_SELECT + " WHERE false", ("P09",))
def q_dim_filter_empty(spark, sf):
    return dims.filter_dimension(T(spark, sf, "lineitem"), [], "l_partkey").select(*_DIM_COLS)


_URI_SQL = ("SELECT page_id, replace(replace(replace(replace(replace(url_encode(url), '%2A', '*'), "
            "'%21', '!'), '%27', ''''), '%28', '('), '%29', ')') AS encoded FROM pages")


@query("uri_encode", _URI_SQL, ("F19",))
def q_uri_encode(spark, sf):
    p = T(spark, sf, "pages")
    return p.select("page_id", uri_component("url").alias("encoded"))


_KEYS = [str(i) for i in range(1, 40, 3)]


@query("dim_filter_keys", _DIM_SELECT + f" WHERE l_partkey IN ({', '.join(_KEYS)})", ("J06", "U01"))
def q_dim_filter_keys(spark, sf):
    """A list of text keys on a number column."""
    return dims.filter_dimension(T(spark, sf, "lineitem"), [*_KEYS, None], "l_partkey").select(*_DIM_COLS)


_PAIRS = [(i, i % 4 + 1) for i in range(1, 60)]


@query("dim_filter_pair_list", _DIM_SELECT + " WHERE (l_partkey, l_linenumber) IN ("
       + ", ".join(f"({a}, {b})" for a, b in _PAIRS) + ")", ("J07", "J08", "U02"))
def q_dim_filter_pair_list(spark, sf):
    pairs = [(str(a), str(b)) for a, b in _PAIRS]
    return dims.filter_nodes(T(spark, sf, "lineitem"), pairs, "l_partkey", "l_linenumber").select(*_DIM_COLS)


@query("predicate_columns", """
SELECT c_custkey, c_nationkey = 7 AS number_equal, c_mktsegment = 'BUILDING' AS optional_equal,
       false AS optional_none, c_acctbal > 0 AS text_true FROM customer""", ("P05", "P07", "P08"))
def q_predicate_columns(spark, sf):
    c = T(spark, sf, "customer").withColumn("nation", F.col("c_nationkey").cast("string")) \
        .withColumn("flag", F.when(F.col("c_acctbal") > 0, "True ").otherwise("no"))
    return c.select("c_custkey", eq_number("nation", 7).alias("number_equal"),
                    eq_optional("c_mktsegment", "BUILDING").alias("optional_equal"),
                    eq_optional("c_mktsegment", None).alias("optional_none"), text_is_true("flag").alias("text_true"))


@query("clean_columns", "SELECT r_regionkey AS region_key, r_name AS a_b FROM region", ("P12", "P13"))
def q_clean_columns(spark, sf):
    r = T(spark, sf, "region").select(F.col("r_regionkey").alias(" region key"), F.lit(1).alias("x"),
                                      F.col("r_name").alias("a+b "))
    return clean_names(drop_position(r, 1))


@query("missing_as_nan", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 'NaN'::DOUBLE END AS balance FROM customer""", ("P15",))
def q_missing_as_nan(spark, sf):
    from corvid.ml.models import nan_for_missing
    c = T(spark, sf, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))
    return nan_for_missing(c, ["balance"])


@query("sorted_top", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50""", ("O01", "O04"))
def q_sorted_top(spark, sf):
    return shape.shape(T(spark, sf, "orders"), select="o_orderkey,o_totalprice",
                       order_by="o_totalprice desc,o_orderkey asc", limit=50)


@query("text_timestamp_parts", """
SELECT event_id, CAST(year(t) AS INTEGER) AS year, CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day,
       CAST(weekofyear(t) AS INTEGER) AS week_num, CAST(hour(t) AS INTEGER) AS hour_of_day,
       CASE WHEN dayofweek(t) IN (0, 6) THEN 1 ELSE 0 END AS weekend,
       CAST((month(t) % 12) // 3 + 1 AS INTEGER) AS season, CAST(dayofweek(t) + 1 AS INTEGER) AS week_day
FROM (SELECT event_id, date_trunc('second', ts) + INTERVAL 5 HOUR AS t FROM events) e""", ("F18",))
def q_text_timestamp_parts(spark, sf):
    """Timestamps as text in a zone five hours behind UTC, parsed and split into calendar parts."""
    e = T(spark, sf, "events").select("event_id", F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("text"))
    return e.select("event_id", parse_local_timestamp("text", zone="-05:00").alias("t")) \
        .select("event_id", *calendar_parts("t"))
