"""ML queries (rows-only checks: model output has no SQL oracle)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corvid.functions.dates import calendar_parts
from corvid.ml import models as ml
from corvid.operators import activity as act
from corvid.operators import joins
from corvid.operators import text
from corvid.plans.registry import query
from corvid.plans.standins import ACTIONS_SQL, ORIGIN, PUB_REFERENCE, SONGS_SQL, actions_view, songs_view
from corvid.session import scratch_path
from corvid.sources.tables import load_table

_TRAIN_BELOW = 1800
_FORECAST_START = "2001-12-01"


def _features(spark, sf):
    songs = songs_view(load_table(spark, sf, "part"))
    actions = actions_view(load_table(spark, sf, "lineitem"))
    feats = act.forecast_features(act.daily_activity(songs, actions, origin=ORIGIN), PUB_REFERENCE)
    # one model over all artists: the artist enters as its mean label on training days
    feats = ml.encode_key(feats, "artist_id", "label", F.col("day_num") < _TRAIN_BELOW, "artist_mean")
    return ml.assemble(feats, act.FEATURE_COLS + ["artist_mean"])


@query("tree_forecast", None, ("M03", "M23", "M24", "M25", "K03", "W02"))
def q_tree_forecast(spark, sf):
    data = _features(spark, sf).cache()
    train, test = act.train_test_days(data.drop("features"), train_below=_TRAIN_BELOW)
    train = ml.assemble(train, act.FEATURE_COLS + ["artist_mean"])
    test = ml.assemble(test, act.FEATURE_COLS + ["artist_mean"])
    _, pred = ml.decision_tree(data, train, test)
    return act.forecast_dates(pred, _FORECAST_START, 60, order_col="day_num")


@query("forest", None, ("M04",))
def q_forest(spark, sf):
    _, pred = ml.random_forest(_features(spark, sf))
    return pred.select("artist_id", "ds", "label", F.round("prediction", 4).alias("prediction"))


@query("gbt_regression", None, ("M12", "M14"))
def q_gbt_regression(spark, sf):
    data = _features(spark, sf).withColumn("_key", F.concat_ws("|", "artist_id", "ds"))
    train, test = ml.hash_split(data, "_key", 80)
    _, pred = ml.gbt_regression(train, test)
    return pred.select("artist_id", "ds", "label", F.round("prediction", 4).alias("prediction"),
                       F.round(F.col("prediction") - F.col("label"), 4).alias("residual"))


@query("linear_regression_ml", None, ("M01", "M02", "M07", "M06"))
def q_linear_regression_ml(spark, sf):
    li = load_table(spark, sf, "lineitem")
    data = ml.assemble(li.select(F.col("l_extendedprice").alias("label"), "l_quantity", "l_discount",
                                 (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_key")),
                       ["l_quantity", "l_discount"])
    rows = []
    # 80/20 split, regularization 0.3, RMSE on the held-out part
    train, test = ml.hash_split(data, "_key", 80)
    m, _ = ml.linear_regression(train, max_iter=100, reg=0.3, elastic_net=0.8)
    rows.append(("split_80_20", [float(x) for x in m.coefficients], float(m.intercept),
                 float(ml.rmse(m.transform(test))), float(m.summary.r2), int(m.summary.totalIterations)))
    for name, reg, en in (("elastic_net", 0.0, 0.8), ("ridge", 0.3, 0.0), ("lasso", 0.3, 1.0)):
        m, _ = ml.linear_regression(data, max_iter=100, reg=reg, elastic_net=en)
        s = m.summary
        rows.append((name, [float(x) for x in m.coefficients], float(m.intercept),
                     float(s.rootMeanSquaredError), float(s.r2), int(s.totalIterations)))
    return spark.createDataFrame(rows, "variant string, coefficients array<double>, intercept double, "
                                       "rmse double, r2 double, iterations int")


@query("glm_gamma", None, ("M10",))
def q_glm_gamma(spark, sf):
    li = load_table(spark, sf, "lineitem")
    data = ml.assemble(li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("label"),
                                 "l_quantity", "l_discount"), ["l_quantity", "l_discount"])
    _, pred = ml.gamma_glm(data, link="log")
    return pred.select("l_orderkey", "l_linenumber", "label", F.round("prediction", 4).alias("prediction"))


def _embeddings(spark, sf):
    e = load_table(spark, sf, "embeddings")
    return ml.as_vector(e, "embedding").withColumn("label", F.col("label").cast("double"))


@query("kmeans", None, ("M05",))
def q_kmeans(spark, sf):
    m, pred, cost = ml.kmeans(_embeddings(spark, sf), k=2, max_iter=20)
    return pred.select("vec_id", F.col("prediction").alias("cluster"), F.lit(round(cost, 6)).alias("cost"))


@query("logistic_multiclass", None, ("M08",))
def q_logistic(spark, sf):
    _, pred, acc = ml.logistic_multiclass(_embeddings(spark, sf), "vec_id")
    return pred.withColumn("accuracy", F.lit(acc))


@query("mlp", None, ("M13",))
def q_mlp(spark, sf):
    data = _embeddings(spark, sf)
    n = len(data.select("embedding").first()[0])
    train, test = ml.hash_split(data, "vec_id", 80)
    classes = int(data.agg(F.max("label")).first()[0]) + 1
    m = ml.mlp_classifier(train, n, classes, epochs=10)
    return m.transform(test).select("vec_id", "label", "prediction")


@query("tfidf", None, ("M17", "M22"))
def q_tfidf(spark, sf):
    conv = load_table(spark, sf, "conversations")
    toks = text.message_tokens(conv, "text", keep=("conv_id", "turn"))
    _, feats = ml.tfidf(toks)
    arr = vector_to_array("features")
    return feats.select("conv_id", "turn", F.size(F.filter(arr, lambda x: x != 0)).alias("n_terms"),
                        F.round(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x), 4).alias("weight"))


def _labeled_docs(spark, sf, label_col):
    """Tokens of the labelled documents, stored: training and scoring read them several times.
    Documents without a label go before they are split into words."""
    labels = load_table(spark, sf, "labels").select("doc_id", F.col(label_col).cast("double").alias("label"))
    docs = load_table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id")
    path = scratch_path(spark, "labeled-docs")
    toks = text.message_tokens(docs, "text", keep=("doc_id", "label"))
    toks.write.parquet(path)
    return spark.read.schema(toks.schema).parquet(path)


@query("svm", None, ("M09",))
def q_svm(spark, sf):
    model, feats = ml.tfidf(_labeled_docs(spark, sf, "quality"))
    train, test = ml.hash_split(feats, "doc_id", 70)
    _, pred, auc = ml.linear_svm(train, test)
    return pred.select("doc_id", vector_to_array("rawPrediction")[1].alias("score"), "label",
                       F.lit(auc).alias("auc"))


@query("spam_score", None, ("M18", "F20", "M22"))
def q_spam_score(spark, sf):
    tfidf_model, feats = ml.tfidf(_labeled_docs(spark, sf, "toxic"))
    clf, _ = ml.binomial_glm(feats)
    conv = load_table(spark, sf, "conversations")
    msgs = text.message_tokens(conv, "text", keep=("conv_id", "turn"))
    pred = clf.transform(tfidf_model.transform(msgs))
    return ml.spam_flags(pred).select("conv_id", "turn", F.round("p_ham", 6).alias("p_ham"), "verdict")


def _title_tokens(spark, sf):
    """Title tokens of all documents, stored: the vocabulary, the training and what follows each read them."""
    toks = text.title_tokens(load_table(spark, sf, "documents"))
    path = scratch_path(spark, "title-tokens")
    toks.write.parquet(path)
    return spark.read.schema(toks.schema).parquet(path)


@query("word2vec_titles", None, ("M19", "M20", "M21", "A13"))
def q_word2vec_titles(spark, sf):
    toks = _title_tokens(spark, sf)
    model, vecs = ml.word2vec(toks)
    return vecs.select("doc_id", "n_tokens", vector_to_array("vector").alias("vector"))


@query("crime_model", None, ("M11", "M12", "M14", "M15", "M16", "J05", "F18", "P16"))
def q_crime_model(spark, sf):
    o, c, n = (load_table(spark, sf, t) for t in ("orders", "customer", "nation"))
    rows = joins.enrich(
        o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
        [(c.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_acctbal", "c_mktsegment"),
          "o_custkey"),
         (n.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")])
    rows = rows.select("*", *calendar_parts("o_orderdate")) \
        .withColumn("label", (F.col("o_orderstatus") == "F").cast("double"))
    rows = ml.categorical(rows, ["o_orderpriority", "c_mktsegment", "n_name"])
    cols = ["o_totalprice", "c_acctbal", "year", "month", "week_day", "season",
            "o_orderpriority_idx", "c_mktsegment_idx", "n_name_idx"]
    data = ml.assemble(rows, cols)
    train, test = ml.hash_split(data, "o_orderkey", 80)
    gbt = ml.gbt_classifier(train)
    glm, _ = ml.binomial_glm(train)
    mlp = ml.mlp_classifier(train, len(cols), 2, hidden=(200, 200), epochs=10)
    # Train and test AUC of two models (boosted trees, neural network)
    auc_gbt_train, auc_gbt_test = ml.auc(gbt, train), ml.auc(gbt, test)
    auc_mlp_train, auc_mlp_test = ml.auc(mlp, train), ml.auc(mlp, test)
    drop = ("rawPrediction", "probability", "prediction")
    scored = ml.probability_of(gbt.transform(test), 1, "p_gbt").drop(*drop)
    scored = ml.probability_of(glm.transform(scored), 1, "p_glm").drop(*drop)
    scored = ml.probability_of(mlp.transform(scored), 1, "p_mlp")
    return scored.select("o_orderkey", F.round("p_gbt", 6).alias("p_gbt"), F.round("p_glm", 6).alias("p_glm"),
                         F.round("p_mlp", 6).alias("p_mlp"),
                         F.lit(auc_gbt_train).alias("auc_gbt_train"), F.lit(auc_gbt_test).alias("auc_gbt_test"),
                         F.lit(auc_mlp_train).alias("auc_mlp_train"), F.lit(auc_mlp_test).alias("auc_mlp_test"))


@query("word2vec_synonyms", None, ("M19",))
def q_word2vec_synonyms(spark, sf):
    toks = _title_tokens(spark, sf)
    model, _ = ml.word2vec(toks, rows=False)
    top = (toks.select(F.explode("tokens").alias("w")).groupBy("w").count()
           .orderBy(F.col("count").desc(), F.col("w")).limit(1).first())
    return model.findSynonyms(top["w"], 5).withColumn("of_word", F.lit(top["w"]))


_OLS_SQL = """
WITH m AS (SELECT covar_pop(l_quantity, l_quantity) AS c11, covar_pop(l_discount, l_discount) AS c22,
                  covar_pop(l_quantity, l_discount) AS c12, covar_pop(l_quantity, l_extendedprice) AS c1y,
                  covar_pop(l_discount, l_extendedprice) AS c2y, var_pop(l_extendedprice) AS vy,
                  avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my FROM lineitem),
b AS (SELECT (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS b1,
             (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS b2, * FROM m)
SELECT round(b1, 4) AS coef_quantity, round(b2, 2) AS coef_discount,
       round(my - b1 * m1 - b2 * m2, 2) AS intercept, round((b1 * c1y + b2 * c2y) / vy, 6) AS r2
FROM b"""


@query("ols_two_features", _OLS_SQL, ("M01", "S04"))
def q_ols_two_features(spark, sf):
    """M01 without regularization: Spark ML's normal-equation solver gives the
    exact least-squares fit, so closed-form SQL can check it."""
    li = load_table(spark, sf, "lineitem")
    data = ml.assemble(li.select(F.col("l_extendedprice").alias("label"), "l_quantity", "l_discount"),
                       ["l_quantity", "l_discount"])
    m, _ = ml.linear_regression(data, reg=0.0, elastic_net=0.0, solver="normal")
    fit = spark.createDataFrame(
        [(float(m.coefficients[0]), float(m.coefficients[1]), float(m.intercept), float(m.summary.r2))],
        "coef_quantity double, coef_discount double, intercept double, r2 double")
    return fit.select(F.round("coef_quantity", 4).alias("coef_quantity"),
                      F.round("coef_discount", 2).alias("coef_discount"),
                      F.round("intercept", 2).alias("intercept"), F.round("r2", 6).alias("r2"))


_ACT_LABEL_SQL = f"""
WITH songs AS ({SONGS_SQL}), actions AS ({ACTIONS_SQL}),
act AS (SELECT artist_id, CAST(count(*) FILTER (WHERE action_type = '1') AS DOUBLE) AS label,
               date_diff('day', DATE '{ORIGIN}', strptime(Ds, '%Y%m%d')::DATE) AS day_num
        FROM actions JOIN songs USING (song_id) GROUP BY artist_id, Ds
        HAVING count(*) FILTER (WHERE action_type = '1') > 0)"""


@query("artist_encoding", _ACT_LABEL_SQL + f"""
SELECT artist_id, count(*) AS n_days, round(coalesce(avg(label) FILTER (WHERE day_num < {_TRAIN_BELOW}),
       (SELECT avg(label) FROM act WHERE day_num < {_TRAIN_BELOW})), 6) AS artist_mean
FROM act GROUP BY artist_id""", ("M23", "M25"))
def q_artist_encoding(spark, sf):
    """The numeric artist feature of the pooled forecast models, for any number of artists."""
    return _features(spark, sf).groupBy("artist_id").agg(
        F.count(F.lit(1)).alias("n_days"), F.round(F.first("artist_mean"), 6).alias("artist_mean"))


@query("hash_split_rows", """
SELECT o_orderkey, ('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || '|0'), 1, 8))::BIGINT % 100 < 80 AS train
FROM orders""", ("M14",))
def q_hash_split_rows(spark, sf):
    orders = load_table(spark, sf, "orders").select("o_orderkey")
    train, test = ml.hash_split(orders, "o_orderkey", 80)
    return train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))


@query("category_index", """
SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS DOUBLE) AS idx
FROM (SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1) t""", ("P16",))
def q_category_index(spark, sf):
    rows = ml.categorical(load_table(spark, sf, "orders").select(F.col("o_orderpriority").alias("value")), ["value"])
    return rows.select("value", F.col("value_idx").alias("idx")).distinct()


@query("auc_exact", """
WITH r AS (SELECT CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
                  rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS rk
           FROM orders)
SELECT round((sum(rk) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))), 8) AS auc
FROM r""", ("M15", "M09"))
def q_auc_exact(spark, sf):
    """Area under ROC of a plain score column, without binning (ties count half)."""
    rows = load_table(spark, sf, "orders").select(F.col("o_totalprice").alias("rawPrediction"),
                                                  (F.col("o_orderstatus") == "F").cast("double").alias("label"))
    auc = ml.BinaryClassificationEvaluator(numBins=0).evaluate(rows)
    return spark.range(1).select(F.round(F.lit(float(auc)), 8).alias("auc"))


@query("ridge_closed_form", """
WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my,
                  stddev_samp(l_quantity) AS sx, stddev_samp(l_extendedprice) AS sy,
                  covar_pop(l_quantity, l_extendedprice) AS cxy, var_pop(l_quantity) AS vx FROM lineitem),
b AS (SELECT (cxy / sx) / (vx / (sx * sx) + 0.3 / sy) / sx AS b1, * FROM m)
SELECT round(b1, 2) AS slope, round(my - b1 * mx, 1) AS intercept FROM b""", ("M07",))
def q_ridge_closed_form(spark, sf):
    """Ridge on one feature: Spark standardises feature and label by the sample deviation."""
    li = load_table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("label"), "l_quantity")
    m, _ = ml.linear_regression(ml.assemble(li, ["l_quantity"]), reg=0.3, elastic_net=0.0, solver="normal")
    return spark.range(1).select(F.round(F.lit(float(m.coefficients[0])), 2).alias("slope"),
                                 F.round(F.lit(float(m.intercept)), 1).alias("intercept"))


@query("document_frequency", """
WITH t AS (SELECT DISTINCT conv_id, turn, unnest(string_split(lower(text), ' ')) AS word FROM conversations),
d AS (SELECT word, count(*) AS df FROM t WHERE word <> '' GROUP BY word HAVING count(*) >= 4)
SELECT word, df, round(ln(((SELECT count(*) FROM conversations) + 1) / (df + 1)), 6) AS idf FROM d""", ("M17",))
def q_document_frequency(spark, sf):
    """Document frequency and IDF weight per word, in how many messages it occurs (4 at least)."""
    conv = load_table(spark, sf, "conversations").select("conv_id", "turn", "text")
    words = conv.select("conv_id", "turn", F.explode(F.array_distinct(F.split(F.lower("text"), " "))).alias("word"))
    counts = words.filter("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("df")).filter("df >= 4")
    total = conv.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("idf", F.round(F.log((total + 1) / (F.col("df") + 1)), 6))
