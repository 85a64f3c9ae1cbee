import pytest
from pyspark.sql import functions as F

from corvid.operators.positions import pair_by_position, with_positions


def test_positions_are_dense_over_many_partitions(spark):
    df = spark.range(1000).repartition(37).withColumn("position_key", F.col("id") * -1)
    got = [(r["id"], r["position"]) for r in with_positions(df, "position_key").collect()]
    assert sorted(got) == [(i, 999 - i) for i in range(1000)]
    plan = with_positions(df, "position_key")._jdf.queryExecution().toString()
    assert "Window" not in plan
    assert with_positions(df.limit(0), "id").count() == 0


def test_nulls_and_the_tables_own_order(spark):
    df = spark.createDataFrame([(None,), (3,), (1,)], "x int")
    assert [(r["x"], r["position"]) for r in with_positions(df, "x").orderBy("position").collect()] == [(None, 0), (1, 1), (3, 2)]
    assert sorted(r["position"] for r in with_positions(df).collect()) == [0, 1, 2]


def test_unequal_sides_raise(spark):
    with pytest.raises(ValueError):
        pair_by_position(spark.range(3), spark.range(4).toDF("other"), ("id",), ("other",))
