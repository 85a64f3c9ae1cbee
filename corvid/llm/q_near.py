"""Query op2: near-duplicate groups of all documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import table
from corvid.llm.near_dedup import near_groups
from corvid.llm.registry import query


@query("op2_minhash_near_dedup")
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).select(
        F.col("__id").alias("doc_id"), "n_shingles", "component_id",
        F.coalesce(F.col("__id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
