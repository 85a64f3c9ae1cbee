"""Source / sink round trips: the test tables written in the reference's file
layouts into the shared scratch folder, then read back by our readers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corvid.operators import activity as act
from corvid.plans.registry import query
from corvid.plans.standins import ACTIONS_SQL, SONGS_SQL, actions_view, songs_view
from corvid.session import scratch_path
from corvid.sinks import files as sinks
from corvid.sources import files as src
from corvid.sources.tables import load_table

_HEADER_TYPE = {"bigint": "integer", "int": "integer", "double": "double", "string": "string",
                "boolean": "boolean"}


@query("typed_csv_roundtrip", """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""", ("S01", "K01", "F01", "F15"))
def q_typed_csv_roundtrip(spark, sf):
    c = load_table(spark, sf, "customer")
    path = scratch_path(spark, "typed-csv")
    # the reference layout: "name:type" header, cells padded by a blank
    cols = [F.concat(F.lit(" " if i else ""), F.coalesce(F.col(f.name).cast("string"), F.lit("")))
            for i, f in enumerate(c.schema.fields)]
    names = [f"{f.name}:{_HEADER_TYPE[f.dataType.simpleString()]}" for f in c.schema.fields]
    out = c.select(*[x.alias(n) for x, n in zip(cols, names)])
    out.write.mode("overwrite").option("header", True).option("quote", "\u0000") \
        .option("ignoreLeadingWhiteSpace", False).csv(path)
    return src.read_typed_csv(spark, path)


@query("labeled_points_roundtrip", """
SELECT l_extendedprice AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem""",
       ("S05", "K01"))
def q_labeled_points_roundtrip(spark, sf):
    li = load_table(spark, sf, "lineitem")
    path = scratch_path(spark, "labeled-points")
    line = F.concat(F.col("l_extendedprice").cast("string"), F.lit(","),
                    F.concat_ws(" ", *[F.col(c).cast("string") for c in ("l_quantity", "l_discount", "l_tax")]))
    li.select(line.alias("value")).write.mode("overwrite").text(path)
    lp = src.read_labeled_points(spark, path)
    arr = vector_to_array("features")
    return lp.select("label", arr[0].alias("f0"), arr[1].alias("f1"), arr[2].alias("f2"))


@query("report_files", f"""
WITH songs AS ({SONGS_SQL}), actions AS ({ACTIONS_SQL})
SELECT artist_id, count(*) AS plays, strftime(strptime(Ds, '%Y%m%d'), '%Y/%m/%d') AS day,
       max(song_init_plays) AS max_init_plays,
       strftime(strptime(max(publish_time), '%Y%m%d'), '%Y/%m/%d') AS pub_day
FROM actions JOIN songs USING (song_id) WHERE action_type = '1'
GROUP BY artist_id, Ds""", ("M26", "K02"))
def q_report_files(spark, sf):
    """The daily report written as one CSV file per artist (the reference
    wrote one file for its one artist), then read back."""
    songs = songs_view(load_table(spark, sf, "part"))
    actions = actions_view(load_table(spark, sf, "lineitem"))
    report = sinks.report_lines(act.daily_report(songs, actions))
    path = scratch_path(spark, "report")
    sinks.write_per_key_files(report, "artist_id", path, fmt="csv")
    back = spark.read.schema("plays long, day string, max_init_plays string, pub_day string, artist_id string") \
        .csv(path)
    return back.select("artist_id", "plays", "day", "max_init_plays", "pub_day")


@query("delimited_roundtrip", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS cust_id,
       o_orderstatus AS status, o_orderpriority AS priority, '' AS note FROM orders""", ("S03", "S02", "F01"))
def q_delimited_roundtrip(spark, sf):
    o = load_table(spark, sf, "orders")
    path = scratch_path(spark, "delimited")
    # header-less lines, blanks around cells and an empty trailing cell
    line = F.concat_ws(" , ", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       "o_orderstatus", "o_orderpriority", F.lit(""))
    o.select(line.alias("value")).write.mode("overwrite").text(path)
    return src.read_delimited_strings(spark, path, ["order_id", "cust_id", "status", "priority", "note"])


@query("libsvm_roundtrip", """
SELECT l_extendedprice AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem""",
       ("S06",))
def q_libsvm_roundtrip(spark, sf):
    li = load_table(spark, sf, "lineitem")
    path = scratch_path(spark, "libsvm")
    line = F.concat_ws(" ", F.col("l_extendedprice").cast("string"),
                       *[F.concat(F.lit(f"{i + 1}:"), F.col(c).cast("string"))
                         for i, c in enumerate(("l_quantity", "l_discount", "l_tax"))])
    li.select(line.alias("value")).write.mode("overwrite").text(path)
    arr = vector_to_array("features")
    return src.read_libsvm(spark, path, num_features=3).select(
        "label", arr[0].alias("f0"), arr[1].alias("f1"), arr[2].alias("f2"))


@query("tab_pairs_roundtrip", """
SELECT role AS target, replace(text, chr(10), ' ') AS text FROM conversations""", ("S08", "K01"))
def q_tab_pairs_roundtrip(spark, sf):
    """Messages as ``label<TAB>text`` lines (one message per line: line breaks
    inside a message become blanks), read back by the tab-pair reader."""
    c = load_table(spark, sf, "conversations")
    path = scratch_path(spark, "tab-pairs")
    line = F.concat_ws("\t", "role", F.regexp_replace("text", "\n", " "))
    c.select(line.alias("value")).write.mode("overwrite").text(path)
    return src.read_tab_pairs(spark, path)


def _lines(df, *cells, sep=","):
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") if isinstance(c, str) else c for c in cells]).alias("value"))


@query("numeric_csv_roundtrip", "SELECT l_extendedprice AS y, l_quantity AS x FROM lineitem", ("S04",))
def q_numeric_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "numeric-csv")
    _lines(load_table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity").write.text(path)
    return src.read_numeric_csv(spark, path, "y x")


@query("dense_vectors_roundtrip", "SELECT l_quantity AS f0, l_discount AS f1 FROM lineitem", ("S07",))
def q_dense_vectors_roundtrip(spark, sf):
    path = scratch_path(spark, "dense-vectors")
    _lines(load_table(spark, sf, "lineitem"), "l_quantity", "l_discount", sep=" ").write.text(path)
    arr = vector_to_array("features")
    return src.read_dense_vectors(spark, path).select(arr[0].alias("f0"), arr[1].alias("f1"))


@query("header_by_content_roundtrip", "SELECT n_name AS category, CAST(n_nationkey AS VARCHAR) AS title FROM nation", ("S09",))
def q_header_by_content_roundtrip(spark, sf):
    path = scratch_path(spark, "by-content")
    n = load_table(spark, sf, "nation")
    head = n.limit(1).select(F.lit("category,title").alias("value"))
    _lines(n, "n_name", "n_nationkey").unionByName(head).write.text(path)
    return src.read_csv_drop_header(spark, path)


@query("valid_rows_roundtrip", "SELECT o_orderkey AS k, o_totalprice AS price FROM orders WHERE o_orderkey % 5 <> 0", ("S10", "O06"))
def q_valid_rows_roundtrip(spark, sf):
    """Every fifth key spoils its line (as the feature under test); only whole rows come back."""
    path = scratch_path(spark, "valid-rows")
    bad = F.when(F.col("o_orderkey") % 5 == 0, F.lit("x")).otherwise(F.col("o_totalprice").cast("string"))
    _lines(load_table(spark, sf, "orders"), "o_orderkey", bad).write.text(path)
    return src.read_csv_valid_rows(spark, path, "k bigint, price double", header=False)


@query("inferred_csv_roundtrip", "SELECT CAST(s_suppkey AS INTEGER) AS k, s_name AS name, s_acctbal AS balance FROM supplier", ("S11",))
def q_inferred_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "inferred")
    s = load_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"),
                                                 F.col("s_acctbal").alias("balance"))
    s.write.option("header", True).option("compression", "gzip").csv(path)
    return src.read_csv_inferred(spark, path)


@query("patients_roundtrip", """
SELECT CAST(l_orderkey AS DOUBLE) AS "ID", CAST(l_linenumber AS DOUBLE) AS "CAPSULE", l_quantity AS "AGE",
       l_discount AS "RACE", l_tax AS "DPROS", l_quantity AS "DCAPS", l_extendedprice AS "PSA",
       l_tax AS "VOL", l_discount AS "GLEASON" FROM lineitem""", ("S12",))
def q_patients_roundtrip(spark, sf):
    path = scratch_path(spark, "patients")
    _lines(load_table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
           "l_quantity", "l_extendedprice", "l_tax", "l_discount").write.text(path)
    return src.read_patients(spark, path)


@query("literal_rows_join", """
SELECT o_orderkey, w AS weight FROM orders JOIN (VALUES ('F', CAST(1.5 AS DOUBLE)), ('O', CAST(0.5 AS DOUBLE))) AS t(s, w) ON o_orderstatus = s""", ("S13",))
def q_literal_rows_join(spark, sf):
    weights = src.rows_to_table(spark, [("F", 1.5), ("O", 0.5)], "o_orderstatus string, weight double")
    return load_table(spark, sf, "orders").join(weights, "o_orderstatus").select("o_orderkey", "weight")


@query("one_file_report", f"""
WITH songs AS ({SONGS_SQL}), actions AS ({ACTIONS_SQL})
SELECT artist_id, count(*) AS plays FROM actions JOIN songs USING (song_id) WHERE action_type = '1'
GROUP BY artist_id""", ("K04",))
def q_one_file_report(spark, sf):
    """Plays per artist as one CSV file, a report that is small by nature, replaced and read back."""
    songs, actions = songs_view(load_table(spark, sf, "part")), actions_view(load_table(spark, sf, "lineitem"))
    totals = act.daily_report(songs, actions).groupBy("artist_id").agg(F.sum("plays").alias("plays"))
    target = scratch_path(spark, "one-file") + ".csv"
    sinks.write_one_file(totals.limit(0), target)
    sinks.write_one_file(totals, target)
    return spark.read.schema("artist_id string, plays long").csv(target)
