"""Query op8: exact dedup of all documents."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import table
from corvid.llm.exact_dedup import exact_groups
from corvid.llm.registry import query

SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""


@query("op8_exact_dedup", SQL)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(F.col("__id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")
