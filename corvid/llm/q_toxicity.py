"""Query op5: toxicity score of every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import table
from corvid.llm.registry import query
from corvid.llm.toxicity import fit, held_out, with_score


@query("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return (with_score(docs, model)
            .select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
