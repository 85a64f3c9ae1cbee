"""Reading the parquet tables of a scale-factor folder (S18 style access)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; column pruning and filters still reach the reader."""
    return spark.read.parquet(table_path(sf_dir, name))


def register_tables(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> None:
    """Register every table as a temp view so SQL text (Q01) can use it."""
    for n in names:
        load_table(spark, sf_dir, n).createOrReplaceTempView(n)
