import os

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corvid.ml import models as ml
from corvid.plans import ml_queries
from corvid.sources import files as src


def test_linear_regression_exact_line(spark):
    df = ml.assemble(spark.createDataFrame([(float(i), float(i)) for i in range(1, 6)], "label double, x double"), ["x"])
    m, pred = ml.linear_regression(df, max_iter=100)
    assert m.coefficients[0] == pytest.approx(1.0, abs=1e-6)
    assert m.intercept == pytest.approx(0.0, abs=1e-6)
    assert m.summary.r2 == pytest.approx(1.0, abs=1e-9)


def test_kmeans_two_groups(spark, tmp_dir):
    p = os.path.join(tmp_dir, "km.txt")
    with open(p, "w") as f:
        f.write("1.0 0.0 0.0\n1.5 0.0 0.0\n2.0 0.0 0.0\n7.0 0.0 0.0\n7.5 0.0 0.0\n8.0 0.0 0.0\n")
    m, pred, cost = ml.kmeans(src.read_dense_vectors(spark, p), k=2)
    centres = sorted(round(c[0], 6) for c in m.clusterCenters())
    assert centres == [1.5, 7.5]
    assert cost == pytest.approx(1.0, abs=1e-6)


def test_hash_split_is_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = ml.hash_split(df, "k", 80)
    a2, _ = ml.hash_split(df.repartition(7), "k", 80)
    assert a.count() + b.count() == 1000
    assert sorted(r.k for r in a.collect()) == sorted(r.k for r in a2.collect())


def test_tfidf_and_spam_flags(spark):
    rows = [(1.0, ["win", "cash", "now"]), (0.0, ["see", "you", "soon"])] * 4
    df = spark.createDataFrame(rows, "label double, tokens array<string>")
    model, feats = ml.tfidf(df, min_doc_freq=1)
    clf, _ = ml.binomial_glm(feats, reg=0.0)
    flags = ml.spam_flags(clf.transform(feats))
    got = {tuple(r.tokens): r.verdict for r in flags.select("tokens", "verdict").collect()}
    assert got[("win", "cash", "now")] == "spam" and got[("see", "you", "soon")] == "ham"


def test_categorical_keeps_unseen(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    out = ml.categorical(df, ["c"])
    assert sorted(r.c_idx for r in out.collect()) == [0.0, 1.0]


def test_word2vec_unknown_word_is_zero(spark):
    df = spark.createDataFrame([(["a", "b"],)] * 10 + [(["zzz"],)], "tokens array<string>")
    m, vecs = ml.word2vec(df, size=4, min_count=5)
    v = vecs.filter(F.array_contains("tokens", "zzz")).select(vector_to_array("vector")).first()[0]
    assert v == [0.0, 0.0, 0.0, 0.0]


def test_word2vec_trains_in_the_tasks_that_run_at_a_time(spark):
    df = spark.createDataFrame([(["a", "b"],)] * 10, "tokens array<string>").repartition(200)
    m, _ = ml.word2vec(df, size=4)
    assert m.getNumPartitions() == min(200, spark.sparkContext.defaultParallelism)
    m, _ = ml.word2vec(df.coalesce(1), size=4)
    assert m.getNumPartitions() == 1


def test_word2vec_splits_titles_once(spark, tmp_dir):
    rows = [(i, "red green blue red green") for i in range(20)] + [(20, "once only words"), (21, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(os.path.join(tmp_dir, "documents.parquet"))
    out = ml_queries.q_word2vec_titles(spark, tmp_dir)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "split(" not in plan      # read from the stored tokens
    assert sorted((r.doc_id, r.n_tokens) for r in out.collect()) == [(i, 5) for i in range(20)]


def test_tree_fits_any_number_of_artists(spark):
    rows = spark.range(5000 * 4).select((F.col("id") % 5000).cast("string").alias("artist_id"),
                                        (F.col("id") / 5000).cast("int").cast("double").alias("day_num"),
                                        (F.col("id") % 7).cast("double").alias("label"))
    df = ml.encode_key(rows, "artist_id", "label", F.col("day_num") < 2, "artist_mean")
    data = ml.assemble(df, ["day_num", "artist_mean"])
    for fit in (lambda: ml.decision_tree(data, data, data)[1], lambda: ml.random_forest(data, num_trees=2)[1],
                lambda: ml.gbt_regression(data, data, trees=2)[1]):
        assert fit().count() == 20_000


def test_key_encoding_uses_training_rows_only(spark):
    rows = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 4.0), ("a", 9, 100.0), ("b", 9, 7.0)], "k string, d int, y double")
    got = {r.k: r.m for r in ml.encode_key(rows, "k", "y", F.col("d") < 5, "m").collect()}
    assert got == {"a": 3.0, "b": 3.0}


def test_tree_with_as_many_values_as_categories(spark):
    df = ml.assemble(spark.range(400).select((F.col("id") % 100).cast("double").alias("x"),
                                             F.col("id").cast("double").alias("label")), ["x"])
    assert ml.decision_tree(df, df, df)[1].count() == 400


def test_labeled_documents_are_split_into_words_once(spark, tmp_dir):
    docs = [(1, "Good words, good deeds"), (2, "no label here"), (3, None), (1, "Twice the same id")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, 1), (3, 0), (9, 1)], "doc_id long, quality int").write.parquet(f"{tmp_dir}/labels.parquet")
    got = ml_queries._labeled_docs(spark, tmp_dir, "quality")
    assert "corvid/labeled-docs-" in got.inputFiles()[0]              # read back, not computed again on each pass
    rows = sorted((r.doc_id, r.label, r.tokens) for r in got.collect())
    assert rows == [(1, 1.0, ["good", "words", "deeds"]), (1, 1.0, ["twice", "same"]), (3, 0.0, None)]
