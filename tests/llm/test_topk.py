"""Exact top-k against brute force: blocks, ties, odd vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.topk import threshold_top, top_k
from llm_fixtures import package  # noqa: F401

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("score", T.IntegerType())])


def brute(rows, k):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, (i, v) in enumerate(good):
        if i % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), j) for r, (j, w) in enumerate(good) if r != q)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("block,queries", [(16, 2), (4096, 4096)])
def test_equals_brute_force(spark, block, queries):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.3, 8).round(1).tolist()) for i in range(260)]
    rows += [(300 + i, rows[0][1]) for i in range(12)] + [(400, None), (401, [None] * 8), (402, [float("nan")] * 8),
             (403, [float("inf")] + [0.0] * 7), (450, [0.0] * 8), (500, [0.5] * 5), (501, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = top_k(df, F.col("vec_id") % 50 == 0, block=block, queries=queries).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute(rows, 5)


def test_few_and_no_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, -1.0], 1), (0, [1.0, -1.0], 1), (7, [0.5, 0.5], 1)], SCHEMA)
    got = top_k(df, F.col("vec_id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == [
        (0, 1, 0, 131072), (0, 1, 0, 131072), (0, 2, 7, 0), (0, 2, 7, 0)]
    assert top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_null_ids_stay_null_and_come_last_in_ties(spark):
    df = spark.createDataFrame([(0, [1.0], 1), (None, [1.0], 1), (9, [1.0], 1), (5, [0.5], 1)], SCHEMA).withColumn("rank", F.lit(1))
    got = top_k(df, F.col("vec_id").isNull() | (F.col("vec_id") == 0), k=2).collect()
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=repr) == sorted(
        [(0, 1, 9, 65536), (0, 2, None, 65536), (None, 1, 0, 65536), (None, 2, 9, 65536)], key=repr)


def test_reading_stops_early():
    rng = np.random.default_rng(5)
    block = rng.normal(0, 10, (5000, 3)).astype(np.int64).astype(float)
    query = np.array([5.0, -3.0, 0.0])
    order = np.argsort(block, axis=0, kind="stable")
    values = np.take_along_axis(block, order, axis=0)

    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                Counted.read += len(key)
            return np.asarray(super().__getitem__(key))

    best = threshold_top(block.view(Counted), np.arange(5000), np.arange(5000), query, 0, 5, order, values)
    score = block @ query
    assert sorted(score[best].tolist()) == sorted(sorted(score[1:].tolist())[-5:])
    assert Counted.read < 2500
