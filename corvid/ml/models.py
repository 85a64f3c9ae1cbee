"""ML jobs re-expressed with ``pyspark.ml`` estimators.

All training is distributed by Spark ML (tree aggregation over
partitions); features are assembled with column expressions, never
collected.  Splits use a hash of a key column so they are repeatable and
survive recomputation after an executor loss (``hash_split``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import HashingTF, IDF, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, GeneralizedLinearRegression,
                                   LinearRegression, RandomForestRegressor)
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvid.ml import word_vectors


# ---- helpers ------------------------------------------------------------------
def assemble(df: DataFrame, cols, out: str = "features") -> DataFrame:
    """Feature vector from numeric columns."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def as_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array_col).cast("array<double>")))


def hash_percent(key: str, seed: int = 0) -> Column:
    """0..99 from the first 8 hex digits of the MD5 of key and seed as text."""
    text = F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % 100).cast("int")


def hash_split(df: DataFrame, key: str, train_pct: int = 80, seed: int = 0):
    """Repeatable split by a hash of ``key`` (train_pct % / rest)."""
    h = hash_percent(key, seed)
    return df.filter(h < train_pct), df.filter(h >= train_pct)


def encode_key(df: DataFrame, key: str, label: str, train: Column, out: str) -> DataFrame:
    """A key of any number of values as one number: its mean label over training rows
    (grouped aggregate joined back; a key without training rows gets the overall mean)."""
    seen = df.filter(train)
    means = seen.groupBy(key).agg(F.avg(label).alias("_mean"))
    overall = seen.agg(F.avg(label)).scalar()
    return df.join(means, key, "left").withColumn(out, F.coalesce("_mean", overall)).drop("_mean")


def categorical(df: DataFrame, cols, suffix: str = "_idx") -> DataFrame:
    """String columns of few values -> category indexes, the most frequent first, then by
    value (unseen values kept as an extra index).  For keys of many values see :func:`encode_key`."""
    cols = list(cols)
    if not cols:
        return df
    idx = StringIndexer(inputCols=cols, outputCols=[c + suffix for c in cols], handleInvalid="keep")
    return idx.fit(df).transform(df)


def nan_for_missing(df: DataFrame, cols) -> DataFrame:
    """Missing numeric value -> NaN."""
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def rmse(pred: DataFrame, label: str = "label") -> float:
    return RegressionEvaluator(labelCol=label, metricName="rmse").evaluate(pred)


# ---- regression ---------------------------------------------------------------
def linear_regression(df: DataFrame, max_iter: int = 100, reg: float = 0.0,
                      elastic_net: float = 0.8, solver: str = "auto"):
    """Linear regression; returns (model, predictions).

    ``elastic_net`` 0 = ridge, 1 = lasso (M07).  ``model.summary`` holds the
    coefficients, iterations, objective history, residuals, RMSE and r2.
    """
    lr = LinearRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net, solver=solver)
    m = lr.fit(df)
    return m, m.transform(df)


def decision_tree(data: DataFrame, training: DataFrame, test: DataFrame,
                  max_categories: int = 100, max_bins: int = 100):
    """Indexer fitted on all data (<= max_categories values = categorical,
    unseen values kept), tree regressor, pipeline; returns predictions on test."""
    indexer = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=max_categories,
                            handleInvalid="keep").fit(data)
    # a categorical feature may have all its categories and the one for unseen values
    dt = DecisionTreeRegressor(featuresCol="indexed", maxBins=max(max_bins, max_categories + 1))
    model = Pipeline(stages=[indexer, dt]).fit(training)
    return model, model.transform(test)


def random_forest(data: DataFrame, max_categories: int = 4, num_trees: int = 20, seed: int = 7):
    """Forest regressor, train = test = all data."""
    indexer = VectorIndexer(inputCol="features", outputCol="indexed", maxCategories=max_categories,
                            handleInvalid="keep").fit(data)
    rf = RandomForestRegressor(featuresCol="indexed", numTrees=num_trees, seed=seed)
    model = Pipeline(stages=[indexer, rf]).fit(data)
    return model, model.transform(data)


def gbt_regression(train: DataFrame, test: DataFrame, trees: int = 10, depth: int = 5, seed: int = 7):
    """Gradient-boosted trees regression."""
    m = GBTRegressor(maxIter=trees, maxDepth=depth, seed=seed).fit(train)
    return m, m.transform(test)


def gbt_score_table(train: DataFrame, valid: DataFrame, trees: int = 10, depth: int = 5, seed: int = 7) -> DataFrame:
    """``trees, train_mse, valid_mse``: the error after each tree on both frames."""
    m = GBTRegressor(maxIter=trees, maxDepth=depth, seed=seed).fit(train)
    scores = zip(m.evaluateEachIteration(train, "squared"), m.evaluateEachIteration(valid, "squared"))
    return train.sparkSession.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(scores, 1)],
                                              "trees int, train_mse double, valid_mse double")


def gamma_glm(df: DataFrame, link: str = "inverse", reg_grid=(0.0, 0.01, 0.1), seed: int = 7):
    """Gamma GLM with an explicit link and a regularization search
    (the reference's lambda search) by train/validation split."""
    glm = GeneralizedLinearRegression(family="gamma", link=link, maxIter=50)
    grid = ParamGridBuilder().addGrid(glm.regParam, list(reg_grid)).build()
    tvs = TrainValidationSplit(estimator=glm, estimatorParamMaps=grid,
                               evaluator=RegressionEvaluator(metricName="rmse"), trainRatio=0.8, seed=seed)
    m = tvs.fit(df)
    return m.bestModel, m.bestModel.transform(df)


# ---- classification ---------------------------------------------------------------
def logistic_multiclass(df: DataFrame, key: str, seed: int = 11):
    """Multinomial logistic regression (L-BFGS), 60/40 split by a hash of
    ``key``; returns (model, (prediction, label) on the test part, accuracy)."""
    train, test = hash_split(df, key, 60, seed)
    m = LogisticRegression(family="multinomial", maxIter=100).fit(train)
    pred = m.transform(test)
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(pred)
    return m, pred.select("prediction", "label"), acc


def binomial_glm(df: DataFrame, alpha: float = 0.5, reg: float = 0.01):
    """Binomial GLM with elastic-net mixing ``alpha``."""
    m = LogisticRegression(elasticNetParam=alpha, regParam=reg, maxIter=100).fit(df)
    return m, m.transform(df)


def linear_svm(train: DataFrame, test: DataFrame, max_iter: int = 100):
    """Linear SVM; raw scores and area under ROC."""
    m = LinearSVC(maxIter=max_iter).fit(train)
    pred = m.transform(test)
    auc = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", numBins=0).evaluate(pred)
    return m, pred, auc


def gbt_classifier(train: DataFrame, trees: int = 10, depth: int = 6, seed: int = 7):
    """Bernoulli GBT, 10 trees of depth 6."""
    return GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed).fit(train)


def mlp_classifier(train: DataFrame, n_features: int, n_classes: int, hidden=(200, 200),
                   epochs: int = 10, seed: int = 7):
    """Multilayer perceptron (no L1 and no variable importance in Spark ML)."""
    layers = [n_features, *hidden, n_classes]
    return MultilayerPerceptronClassifier(layers=layers, maxIter=epochs, seed=seed).fit(train)


def auc(model, df: DataFrame) -> float:
    """Exact area under ROC of a binary model on ``df``."""
    return BinaryClassificationEvaluator(numBins=0).evaluate(model.transform(df))


def probability_of(pred: DataFrame, index: int = 1, out: str = "p") -> DataFrame:
    """Probability of class ``index`` as a column."""
    return pred.withColumn(out, vector_to_array("probability")[index])


# ---- clustering -------------------------------------------------------------------
def kmeans(df: DataFrame, k: int = 2, max_iter: int = 20, seed: int = 1):
    """K-means; returns (model, predictions, within-set squared error)."""
    m = KMeans(k=k, maxIter=max_iter, seed=seed).fit(df)
    return m, m.transform(df), m.summary.trainingCost


# ---- text features ------------------------------------------------------------------
def tfidf(tokens: DataFrame, col: str = "tokens", buckets: int = 1 << 10, min_doc_freq: int = 4):
    """Hashing term frequency + IDF; returns (tf, idf model, features)."""
    tf = HashingTF(inputCol=col, outputCol="tf", numFeatures=buckets)
    idf = IDF(inputCol="tf", outputCol="features", minDocFreq=min_doc_freq)
    model = Pipeline(stages=[tf, idf]).fit(tokens)
    return model, model.transform(tokens)


def word2vec(tokens: DataFrame, col: str = "tokens", size: int = 100, min_count: int = 5,
             seed: int = 42, max_iter: int = 1, partitions: int | None = None, rows: bool = True):
    """Word2Vec (:mod:`corvid.ml.word_vectors`); returns (model, ``tokens`` plus the per-row mean of word
    vectors, with unknown words counting as zero vectors, as the reference; without ``rows`` None).
    Trains in as many tasks as the input has partitions, but not more than run at a time, if not told
    otherwise: the vectors that tasks moved are averaged at the end of a round."""
    partitions = partitions or max(1, min(tokens.rdd.getNumPartitions(), tokens.sparkSession.sparkContext.defaultParallelism))
    return word_vectors.fit(tokens, col, size, min_count, seed, max_iter, partitions, rows=rows)


def spam_flags(pred: DataFrame, threshold: float = 0.5, ham_index: int = 0) -> DataFrame:
    """``spam`` when P(ham) < threshold."""
    p_ham = vector_to_array("probability")[ham_index]
    return pred.withColumn("p_ham", p_ham).withColumn(
        "verdict", F.when(F.col("p_ham") < threshold, "spam").otherwise("ham"))


__all__ = [n for n in dir() if not n.startswith("_")] + ["PipelineModel"]
