"""Corpus pipeline: toxicity, exact dedup, near-dedup, personal data, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read back as the next
stage's documents.  All but the last return the columns of ``documents``, in
their order, extra ones included.

Defined cases, the same in every stage: a null text counts as an empty one and
stays null; null ids are ids like any other (for "largest" and "smallest" they
give way to real ones); repeated rows are judged row by row and are copies of each
other; texts are read whole, however long; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import store, table
from corvid.llm.exact_dedup import drop_exact_copies
from corvid.llm.near_dedup import drop_near_copies
from corvid.llm.packing import pack
from corvid.llm.pii import redact
from corvid.llm.q_packing import tokenizer_path
from corvid.llm.registry import reach_package
from corvid.llm.toxicity import fit, with_score

ORACLE_SQL = None      # a learned classifier, EM and a linear program are not SQL; see tests/llm


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of 0.5 or more go."""
    reach_package(spark)
    model = fit(docs, table(spark, sf_dir, "labels"))
    return with_score(docs, model, score_col="__score").filter(F.col("__score") < 0.5).drop("__score")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays."""
    reach_package(spark)
    return drop_near_copies(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; ``n_chars``, where there is one, is that of the masked text (unchanged for a null text)."""
    reach_package(spark)
    masked = redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    reach_package(spark)
    return pack(docs, tokenizer_path(), with_ids=False)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("pii", pii),
          ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
