"""Query op12: documents linked by four-word shingles at 85 percent."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import table
from corvid.llm.ngram_join import jaccard_components
from corvid.llm.registry import query


@query("op12_ngram_jaccard_join")
def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select(
        F.col("__id").alias("doc_id"), "n_shingles", "component_id")
