"""Word vectors from tables: tree, moves against a plain loop, tasks and rounds put together, mean vectors."""

import heapq

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corvid.ml import models as ml
from corvid.ml import word_vectors as wv


def docs(spark, n=400):
    """Words of two subjects that never meet, a rare word, a null list and a row without words."""
    rng = np.random.default_rng(3)
    rows = [(i, [f"{'ab'[i % 2]}{k}" for k in rng.integers(0, 12, 30)]) for i in range(n)]
    return spark.createDataFrame([*rows, (n, ["rare", "a0", "a0"]), (n + 1, None), (n + 2, [])], "id long, tokens array<string>").repartition(6)


def test_neither_words_nor_vectors_are_on_the_driver(spark):
    model, out = ml.word2vec(docs(spark), size=8)
    for df in (model.getVectors(), out):
        assert df.inputFiles() and "/corvid/" in df.inputFiles()[0]      # a stored table, not rows of the driver
    assert "LocalTableScan" not in model.getVectors()._jdf.queryExecution().executedPlan().toString()


def test_tree_is_as_short_as_a_heap_makes_it():
    counts = np.sort(np.random.default_rng(1).integers(5, 400, 300))[::-1]
    parents, bits = wv.huffman(counts)
    nodes = wv.nodes_above(np.arange(300), parents)
    starts, places, targets = wv.paths(np.arange(300), nodes, parents, bits)
    heap, least = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        least += both
        heapq.heappush(heap, both)
    assert (np.diff(starts) * counts).sum() == least
    assert len(nodes) == 299 and parents[-1] == -1
    ways = {tuple(sorted(zip(places[a:b], targets[a:b]))) for a, b in zip(starts, starts[1:])}
    assert len(ways) == 300                          # no two words have the same way
    assert len(wv.paths(np.zeros(1, int), np.zeros(0, int), *wv.huffman(np.array([7])))[1]) == 0


def test_moves_equal_a_plain_loop(monkeypatch):
    monkeypatch.setattr(wv, "_STEP", 1)
    rng = np.random.default_rng(2)
    words = rng.integers(0, 20, 300).astype(np.int32)
    sentence = np.repeat([0, 1, 2], 100)
    counts = np.arange(40, 20, -1)
    parents, bits = wv.huffman(counts)
    nodes = wv.nodes_above(np.arange(20), parents)
    ways = starts, places, targets = wv.paths(np.arange(20), nodes, parents, bits)
    syn0 = rng.normal(size=(20, 6)).astype(np.float32)
    syn1 = rng.normal(size=(19, 6)).astype(np.float32)
    a, b = syn0.astype(float), syn1.astype(float)
    reach = np.random.default_rng(9).integers(1, 6, 300)
    times = np.zeros(20)
    for p in range(300):
        around = [c for c in range(max(p - reach[p], 0), min(p + reach[p], 299) + 1) if c != p and sentence[c] == sentence[p]]
        x, y = a.copy(), b.copy()
        for c in around:
            times[words[c]] += 1
            for at in range(starts[words[p]], starts[words[p] + 1]):
                f = x[words[c]] @ y[places[at]]
                if abs(f) < 6:
                    g = (targets[at] + 0.5 - 1 / (1 + np.exp(-f))) * 0.05
                    a[words[c]] += g * y[places[at]]
                    b[places[at]] += g * x[words[c]]
    moved = np.zeros(20, np.float32), np.zeros(19, np.float32)
    wv.move(words, sentence, syn0, syn1, ways, 5, 0.05, np.random.default_rng(9), moved)
    assert np.abs(syn0 - a).max() < 1e-3 and np.abs(syn1 - b).max() < 1e-3
    assert moved[0].tolist() == times.tolist()


def rows_of(**vectors):
    return [(int(k[1:]), bytearray(np.array(v, np.float32).tobytes())) for k, v in vectors.items()]


def test_moves_of_tasks_are_put_together(spark):
    old = spark.createDataFrame(rows_of(k1=[1, 1], k2=[1, 1], k3=[1, 1]), wv._VECTORS)
    moved = [(*r, w) for r, w in zip(rows_of(k1=[2, 1]) + rows_of(k1=[1, 4]) + rows_of(k2=[3, 1]) + rows_of(k2=[1, 1]) + rows_of(k9=[5, 7]),
                                     (30.0, 20.0, 9e6, 3e6, 4.0))]
    out = wv._merged(spark.createDataFrame(moved, wv._MOVED), old, 2, 3)
    got = {r["key"]: np.frombuffer(bytes(r["vector"]), np.float32).tolist() for r in out.collect()}
    # seldom moved: both moves; often moved: the mean by how often; not moved: as it was; new: as it came
    assert got == {1: [2.0, 4.0], 2: [2.5, 1.0], 3: [1.0, 1.0], 9: [5.0, 7.0]}


def test_rounds_and_tasks_train_on_all_tokens(spark, monkeypatch):
    df = docs(spark)
    for name, value in (("CHUNK_TOKENS", 500), ("ROUND_TOKENS", 1500), ("LEAST_TOKENS", 300)):
        monkeypatch.setattr(wv, name, value)
    model, out = wv.fit(df, "tokens", 16, 5, 7, 2, 3)
    assert model.rounds == 3                          # 12,000 tokens, 3 tasks of 1,500
    vectors = {r["word"]: np.array(r["vector"]) for r in model.getVectors().collect()}
    assert sorted(vectors) == sorted(f"{s}{k}" for s in "ab" for k in range(12))
    assert all(np.isfinite(v).all() and np.linalg.norm(v) > 0.05 for v in vectors.values())   # none as it began
    near = model.findSynonyms("a3", 5).collect()
    assert [r["word"][0] for r in near] == ["a"] * 5 and near[0]["similarity"] >= near[-1]["similarity"]
    with pytest.raises(ValueError):
        model.findSynonyms("rare", 5)
    assert out.count() == df.count()


def test_row_vectors_are_means_with_zeros_for_unknown_words(spark):
    df = docs(spark).withColumn("n", F.size("tokens"))
    model, out = ml.word2vec(df, size=8)
    assert out.columns == ["id", "tokens", "n", "vector"]
    vectors = {r["word"]: np.array(r["vector"]) for r in model.getVectors().collect()}
    before = {r["id"]: r["tokens"] for r in df.collect()}
    for frame in (out, model.transform(df.repartition(2))):
        got = frame.select("id", "tokens", vector_to_array("vector").alias("v")).collect()
        assert len(got) == len(before)
        for r in got:
            words = before[r["id"]] or []
            assert (r["tokens"] or []) == words
            mean = sum((vectors.get(w, np.zeros(8)) for w in words), np.zeros(8)) / max(len(words), 1)
            assert np.allclose(r["v"], mean, atol=1e-6)
    with pytest.raises(ValueError):
        ml.word2vec(df.limit(0), size=8)
