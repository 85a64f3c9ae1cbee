import pytest
from pyspark.sql import functions as F

from corvid.operators.dims import filter_dimension, filter_dimension_pairs, filter_locations, filter_nodes
from corvid.operators.shape import explain_text


def _facts(spark):
    rows = [(i, f"p{i % 12}", f"l{i % 4}") for i in range(48)] + [(99, None, "l0")]
    return spark.createDataFrame(rows, "id int, productKey string, locationKey string")


def test_zero_keys_keep_schema(spark):
    df = _facts(spark)
    out = filter_dimension(df, [], "productKey")
    assert out.count() == 0 and out.columns == df.columns


@pytest.mark.parametrize("n", [3, 12, 1000])
def test_text_keys_on_a_number_column(spark, n):
    df = spark.range(2000).withColumn("v", F.col("id") % 5)
    keys = [str(i) for i in range(n)] + [None, "no number"]
    assert filter_dimension(df, keys, "id").count() == n
    pairs = [(str(i), str(i % 5)) for i in range(n)] + [(None, "1"), ("0", "4"), ("x", "0")]
    assert filter_dimension_pairs(df, pairs, "id", "v").count() == n
    table = spark.createDataFrame([(k,) for k in keys], "k string")
    assert filter_dimension(df, table, "id").count() == n
    table = spark.createDataFrame(pairs, "a string, b string")
    assert filter_dimension_pairs(df, table, "id", "v").count() == n


def test_null_key_never_matches(spark):
    df = _facts(spark)
    keys = spark.createDataFrame([(None,), ("p1",)], "productKey string")
    assert filter_dimension(df, keys, "productKey").count() == 4
    assert filter_dimension(df, [None, "p1"], "productKey").count() == 4
    assert filter_dimension_pairs(df, [(None, "l0"), ("p0", None)], "productKey", "locationKey").count() == 0


def test_table_form_is_a_semi_join_without_hint(spark):
    df = _facts(spark)
    keys = spark.createDataFrame([("p1",), ("p2",), ("p2",)], "productKey string")
    out = filter_dimension(df, keys, "productKey")
    assert out.count() == 8  # duplicates in the key table do not duplicate rows
    assert "LeftSemi" in explain_text(out)


def test_pairs_and_presets(spark):
    df = _facts(spark)
    assert filter_dimension_pairs(df, [("p1", "l1"), ("p2", "l0")], "productKey", "locationKey").count() == 4
    assert filter_locations(df, "l3").count() == 12
    nodes = spark.createDataFrame([(1, "a"), (2, "b")], "nodeKey int, nodeTypeFlag string")
    assert filter_nodes(nodes, [(1, "a")]).count() == 1
    many = [(i, "a") for i in range(20)]
    assert filter_nodes(nodes, many).count() == 1
