"""Query op7: words of every document outside repeated 35-word windows."""

from pyspark.sql import DataFrame, SparkSession

from corvid.llm.common import table
from corvid.llm.registry import query
from corvid.llm.substring_dedup import remove_repeats


@query("op7_substring_dedup")
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False)
