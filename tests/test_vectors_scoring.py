"""Mean vectors, nearest words, chunks and exported models against plain Python."""

import json
import math

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corvid.ml.scoring import export_linear, flag_below, score_events
from corvid.operators.vectors import mean_vectors, nearest_words
from corvid.sinks.chunks import result_chunks, write_chunks


def test_mean_vectors(spark):
    table = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, -2.0])], "word string, vector array<double>")
    rows = spark.createDataFrame([(1, ["a", "b", "a", "zz"]), (2, []), (3, None), (4, ["zz", None])], "id int, words array<string>")
    got = {r["id"]: (r["n_words"], r["n_known"], r["mean"]) for r in mean_vectors(rows, ["id"], "words", table, 2).collect()}
    assert got == {1: (4, 3, [1.25, 0.5]), 2: (0, 0, [0.0, 0.0]), 3: (0, 0, [0.0, 0.0]), 4: (2, 0, [0.0, 0.0])}
    assert mean_vectors(rows.limit(0), ["id"], "words", table, 2).count() == 0


def test_nearest_words(spark):
    words = {"a": [1.0, 0.0], "b": [1.0, 0.0], "c": [2.0, 0.1], "z": [0.0, 0.0], "far": [-1.0, 0.0], "up": [0.0, 3.0]}
    table = spark.createDataFrame([*words.items(), (None, [1.0, 1.0]), ("none", None)], "word string, vector array<double>").repartition(3)
    got = [(r["asked"], r["rank"], r["word"]) for r in nearest_words(table, ["a", "z", "lost"], 3).orderBy("asked", "rank").collect()]
    assert got == [("a", 1, "b"), ("a", 2, "c"), ("a", 3, "up")]
    cosine = {r["word"]: r["cosine"] for r in nearest_words(table, ["a"], 9).collect()}
    assert cosine["z"] == 0.0 and math.isclose(cosine["c"], 2 / math.sqrt(4.01)) and cosine["far"] == -1.0
    assert nearest_words(table, ["lost"]).count() == 0


def test_chunks_page_and_files(spark, tmp_dir):
    df = spark.range(257).select((F.col("id") * 7 % 257).alias("k"), F.when(F.col("id") > 3, F.lit("x")).alias("v")).repartition(6)
    got = result_chunks(df, 50, drop=10, take=120, order_by="k desc", extra={"b": 1}).orderBy("chunk").collect()
    head = json.loads(got[0]["body"])
    assert (got[0]["chunk"], got[0]["rows"], head["count"], head["extra"]) == (-1, 257, 257, {"b": 1})
    assert [r["rows"] for r in got[1:]] == [50, 50, 20]
    rows = [x for r in got[1:] for x in json.loads(r["body"])]
    assert [x["k"] for x in rows] == list(range(246, 126, -1)) and all("v" in x for x in rows)
    write_chunks(df, f"{tmp_dir}/out", size=100, order_by="k")
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{tmp_dir}/out/chunks").collect()]
    assert sorted(len(x) for x in lines) == [57, 100, 100]
    assert json.loads(spark.read.text(f"{tmp_dir}/out/header").first()["value"])["count"] == 257
    assert result_chunks(df.limit(0), order_by="k").collect()[0]["rows"] == 0


def test_exported_model_equals_the_model(spark):
    df = spark.range(200).select((F.col("id") % 17).alias("x"), (F.col("id") % 5 - 2.5).alias("y"),
                                 ((F.col("id") * 13 % 17) > 8).cast("double").alias("label"))
    data = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    model = LogisticRegression(regParam=0.01).fit(data)
    both = score_events(model.transform(data), export_linear(model, ["x", "y"]))
    worst = both.select(F.max(F.abs(F.col("p") - vector_to_array("probability")[1]))).first()[0]
    assert worst < 1e-12
    assert "model" not in score_events(df, export_linear(model, ["x", "y"]))._jdf.queryExecution().toString().lower()


def test_flags(spark):
    rows = spark.createDataFrame([(0.49,), (0.5,), (None,)], "p double").select(flag_below("p").alias("f")).collect()
    assert [r["f"] for r in rows] == ["spam", "ham", None]
