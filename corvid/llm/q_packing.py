"""Query op4: all documents packed into sequences of at most 4096 tokens."""

from pyspark.sql import DataFrame, SparkSession

from corvid.llm.common import table
from corvid.llm.packing import pack
from corvid.llm.registry import query


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pack(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
