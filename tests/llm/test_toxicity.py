"""Toxicity: held-out accuracy, fold discipline, defined cases."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm.toxicity import choose_features, fit, fit_nnpu, fitting_rows, frequent_only, held_out, levels, with_score
from llm_fixtures import docs, package  # noqa: F401

BAD = ["vilefoo", "grossbar", "nastybaz"]


def corpus(n=600, seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 7))) for _ in range(400)]
    rows, marks = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 80))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(BAD) + rng.choice(["", ".", ","])
        rows.append((i, " ".join(text)))
        if i % 3:
            marks.append((i, int(toxic)))
    return rows, marks


@pytest.fixture
def labelled(spark, docs):
    rows, marks = corpus()
    return docs(rows), spark.createDataFrame(marks, "doc_id long, toxic int")


def test_held_out_rows_are_told_apart(labelled):
    df, marks = labelled
    out = with_score(df, fit(df, marks)).select("doc_id", held_out("doc_id").alias("h"), "score").collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert all(0 <= r["score"] <= 1 for r in out)
    test = [(r["doc_id"] % 8 == 0, r["score"] >= 0.5) for r in out if r["h"]]
    assert np.mean([a == b for a, b in test]) > 0.97


def test_held_out_labels_do_not_matter(spark, labelled):
    df, marks = labelled
    flipped = marks.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = fit(df, marks), fit(df, flipped)
    assert one.columns == two.columns and np.array_equal(one.weights, two.weights)


def test_defined_cases(spark, docs, labelled):
    df, marks = labelled
    model = fit(df, marks.union(marks.limit(3)).union(spark.createDataFrame([(5, None), (None, 1)], "doc_id long, toxic int")))
    odd = docs([(None, None), (1, ""), (1, ""), (2, "…"), (3, "word " * 50_000)]).withColumn("__i", F.lit(0))
    out = with_score(odd, model).collect()
    assert len(out) == 5 and all(0 <= r["score"] < 0.5 for r in out)
    assert with_score(docs([]), model).count() == 0
    none = marks.filter("toxic = 0")
    assert {r["score"] for r in with_score(odd, fit(df, none)).collect()} == {0.0}
    assert {r["score"] for r in with_score(odd, fit(docs([]), marks)).collect()} == {0.0}


def test_levels():
    assert levels(1, 10) == [0] and levels(2, 10_000) == [0, 1] and levels(3, 100) == [0, 1, 2, 3, 4]


def test_non_negative_risk_finds_the_hidden_positives():
    rng = np.random.default_rng(0)
    def rows(n, share):
        return [np.sort(np.concatenate([[1] if p else [], rng.choice(np.arange(10, 60), 8, False)])).astype(np.int64)
                for p in rng.random(n) < share]
    pos, unl = rows(300, 1.0), rows(1000, 0.2)
    chosen = choose_features(pos, unl, 100, 4.0)
    assert 1 in chosen
    w = fit_nnpu(pos, unl, chosen, 0.2)
    at = int(np.searchsorted(chosen, 1))
    assert w[-1] < 0 < w[-1] + w[at]


def test_driver_gets_only_features_that_may_be_chosen(labelled):
    """The fitting rows come as places among the features that three positive rows have, not as all their hashes."""
    df, marks = labelled
    stored = fitting_rows(df, marks, "doc_id", "text", "doc_id", "toxic", 2000, 3500, 1000)
    before = stored.orderBy("at").collect()
    rows, hashes = frequent_only(stored)
    counts = Counter(f for r in before if r["positive"] for f in r["features"])
    assert hashes.tolist() == sorted(f for f, n in counts.items() if n >= 3)
    after = rows.sort_by("at").to_pylist()
    assert [[int(hashes[f]) for f in r["features"]] for r in after] == [[f for f in r["features"] if counts[f] >= 3] for r in before]
    assert rows.schema.field("features").type.value_type.bit_width == 32


def test_fit_leaves_no_freed_memory_behind(labelled, monkeypatch):
    from corvid.llm import toxicity
    called = []
    monkeypatch.setattr(toxicity, "give_memory_back", lambda: called.append(1))
    df, marks = labelled
    fit(df, marks)
    assert called == [1]
