"""Query op6: bytes of every document outside repeated 200-byte strings."""

from pyspark.sql import DataFrame, SparkSession

from corvid.llm.common import table
from corvid.llm.registry import query
from corvid.llm.suffix_dedup import remove_repeats


@query("op6_suffix_array_dedup")
def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False)
