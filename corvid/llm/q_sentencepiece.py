"""Query op9: ids of every document, and whether they decode to it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import table
from corvid.llm.q_packing import tokenizer_path
from corvid.llm.registry import query
from corvid.llm.sentencepiece_codec import decode, encode


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = decode(encode(docs, model), model)
    return both.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"),
                       F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("text") == F.col("decoded")).alias("round_trip"))
