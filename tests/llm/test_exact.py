"""Exact dedup: defined cases, bucket splits, the filtering form."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corvid.llm.exact_dedup import directory, drop_exact_copies, exact_groups
from llm_fixtures import docs, package  # noqa: F401


def groups(df, **kw):
    return {(r["__id"], r["__rid"]): r for r in exact_groups(df, **kw).collect()}


@pytest.mark.parametrize("capacity", [1, 2, 1 << 16])
def test_groups_match_plain_grouping(spark, docs, capacity):
    rows = [(i, f"Text {i % 7} É" if i % 3 else "text 1 É".upper()) for i in range(40)]
    got = {r["__id"]: r for r in exact_groups(docs(rows), capacity=capacity).collect()}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t in rows:
        same = [j for j, u in rows if u.translate(low) == t.translate(low)]
        assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (max(same), len(same), i == max(same))
        assert got[i]["text_sha256"] == hashlib.sha256(t.translate(low).encode()).hexdigest()


def test_defined_cases(docs):
    got = [(r["__id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(docs(
        [(1, None), (2, ""), (3, "ÀB"), (4, "àb"), (5, "x"), (5, "x"), (None, "x"), (None, "y" * 100_000)])).collect()]
    assert sorted(got, key=repr) == sorted(
        [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 4, 1, True), (5, 5, 3, False), (5, 5, 3, True),
         (None, 5, 3, False), (None, None, 1, True)], key=repr)


def test_empty_table(docs):
    assert exact_groups(docs([])).count() == 0
    assert drop_exact_copies(docs([])).count() == 0


def test_rows_stay_whole_with_extra_columns(docs):
    df = docs([(1, "A"), (2, "a"), (3, None), (None, "b")]).withColumn("__key", F.lit("mine")).withColumn("a.b", F.lit(1))
    out = drop_exact_copies(df)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"], r["text"], r["__key"], r["a.b"]) for r in out.collect()), key=repr) == sorted(
        [(2, "a", "mine", 1), (3, None, "mine", 1), (None, "b", "mine", 1)], key=repr)


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(1000).select(F.xxhash64("id").alias("__key"))
    cells, bits = directory(keys, 1000, 64)
    load = (keys.withColumn("cell", F.shiftrightunsigned("__key", 64 - bits)).join(cells, "cell")
            .groupBy("bucket", "depth").count().collect())
    assert sum(r["count"] for r in load) == 1000 and max(r["count"] for r in load) <= 64
    assert len({r["depth"] for r in load}) >= 1 and len(load) > 15
