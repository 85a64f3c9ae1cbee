"""Query op3: personal data in every document."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import table
from corvid.llm.pii import BASE_KINDS, find_pii
from corvid.llm.registry import query


@query("op3_pii")
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"),
                        text(F.col("spans")).alias("spans"))
