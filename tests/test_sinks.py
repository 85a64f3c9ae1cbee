import os

import pytest

from corvid.session import scratch_path
from corvid.sinks import files as sinks
from corvid.sinks.results import iter_json_rows, write_result_document


def test_one_file_writer_replaces_target(spark):
    target = scratch_path(spark, "one") + ".csv"
    sinks.write_one_file(spark.range(5).repartition(3), target)
    assert os.path.isfile(target)
    sinks.write_one_file(spark.range(2), target)
    assert sorted(int(l) for l in open(target).read().split()) == [0, 1]


def test_text_writer_and_cache_scope(spark):
    p = scratch_path(spark, "txt")
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    sinks.write_text(df, p)
    assert sorted(r.value for r in spark.read.text(p).collect()) == ["1,a", "2"]
    with sinks.cached(df) as c:
        assert c.is_cached
    assert not df.is_cached


def test_json_rows_iterator_and_document(spark):
    df = spark.createDataFrame([(1, None)], "x int, y string")
    assert list(iter_json_rows(df)) == ['{"x":1,"y":null}']
    p = scratch_path(spark, "doc")
    write_result_document(df, p, extra={"q": "t"})
    assert spark.read.text(f"{p}/rows").count() == 1


def test_reformat_dates(spark):
    df = spark.createDataFrame([("20150301",)], "d string")
    assert sinks.reformat_dates(df, ["d"]).first().d == "2015/03/01"


def test_per_key_files(spark):
    p = scratch_path(spark, "perkey")
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "k string, v int")
    sinks.write_per_key_files(df.repartition(3), "k", p)
    for k in ("a", "b"):
        files = [f for f in os.listdir(os.path.join(p, f"k={k}")) if f.startswith("part-")]
        assert len(files) == 1
    back = spark.read.schema("v int, k string").csv(p)
    assert sorted((r.k, r.v) for r in back.collect()) == sorted((r.k, r.v) for r in df.collect())


def test_cluster_conf_sizes():
    from corvid.session import cluster_conf
    c = cluster_conf()
    assert int(c["spark.sql.shuffle.partitions"]) == 40960
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_json_chunks(spark):
    from corvid.sinks.results import iter_json_chunks
    sizes = [len(c) for c in iter_json_chunks(spark.range(250).repartition(3), 100)]
    assert sizes == [100, 100, 50]
