"""Query op13: damaged conversations, audited and repaired."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import table
from corvid.llm.conversation_repair import Repair
from corvid.llm.registry import query


def damaged(df: DataFrame) -> DataFrame:
    """Rows of ``conversations`` after the damage that crc32(conv_id:turn) mod 20 names; null texts and roles are one space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, role, text = F.crc32(name) % 20, F.coalesce("role", space), F.coalesce("text", space)
    return (df.filter(kind != 0)
            .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
                    F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
                    F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return Repair(damaged(rows), all_conversations=rows.select("conv_id")).audits()
