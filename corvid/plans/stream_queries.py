"""Streaming queries: documents streamed as files, results read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvid.functions.text import STREAM_STOP_LIST
from corvid.operators import text
from corvid.plans.registry import query
from corvid.plans.sqltext import jsplit, lines
from corvid.session import scratch_path
from corvid.sources.tables import load_table, table_path
from corvid.streaming import text_streams as ts

_WORDS_SQL = f"""
WITH dl AS (SELECT unnest({lines('text')}) AS line FROM documents),
dw AS (SELECT unnest({jsplit('line', ' ', ' +$')}) AS word FROM dl)"""


def _doc_lines(spark, sf):
    """The documents as a stream; the bracketed last letter makes the path a pattern, which a stream takes for a table
    that is one file as well as for one that is a folder of parts."""
    static = load_table(spark, sf, "documents")
    path = table_path(sf, "documents")
    return ts.line_stream(spark, f"{path[:-1]}[{path[-1]}]", fmt="parquet", text_col="text", schema=static.schema)


@query("stream_word_count", _WORDS_SQL + """
SELECT CAST(0 AS INTEGER) AS batch_id, word, count(*) AS n FROM dw GROUP BY word""", ("T01", "T05"))
def q_stream_word_count(spark, sf):
    base = scratch_path(spark, "stream-word-count")
    q = ts.start_batch_word_count(ts.stream_words(_doc_lines(spark, sf)), f"{base}/out", f"{base}/ckpt")
    ts.run_until_done(q)
    return spark.read.parquet(f"{base}/out").select(F.col("batch_id").cast("int"), "word", "n")


@query("stream_stop_list", _WORDS_SQL + f"""
SELECT word, count(*) AS n FROM dw WHERE word NOT IN ({', '.join("'" + w + "'" for w in STREAM_STOP_LIST)})
GROUP BY word""", ("T02", "J09"))
def q_stream_stop_list(spark, sf):
    base = scratch_path(spark, "stream-stop-list")
    kept = ts.stop_list_stream(ts.stream_words(_doc_lines(spark, sf)), STREAM_STOP_LIST)
    q = ts.start_append(kept, f"{base}/out", f"{base}/ckpt")
    ts.run_until_done(q)
    return spark.read.parquet(f"{base}/out").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("stream_stop_table", _WORDS_SQL + f""",
bl AS (SELECT unnest({lines('text')}) AS line FROM benchmark),
bw AS (SELECT DISTINCT unnest({jsplit('line', ' ', ' +$')}) AS word FROM bl)
SELECT word, count(*) AS n FROM dw WHERE NOT EXISTS (SELECT 1 FROM bw WHERE bw.word = dw.word) GROUP BY word""",
       ("T04", "J09"))
def q_stream_stop_table(spark, sf):
    """A stream filtered by a stop list that is a table."""
    base = scratch_path(spark, "stream-stop-table")
    stop = text.line_words(load_table(spark, sf, "benchmark"), "text", " ")
    kept = ts.stop_list_stream(ts.stream_words(_doc_lines(spark, sf)), stop)
    ts.run_until_done(ts.start_append(kept, f"{base}/out", f"{base}/ckpt"))
    return spark.read.parquet(f"{base}/out").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _in_parts(spark, sf, base, parts):
    """The documents dealt by id over ``parts`` folders, for streams that take several batches.
    Every task writes its own files, so a folder holds any number of them, one at least."""
    docs = load_table(spark, sf, "documents").select("doc_id", "text")
    for i in range(parts):
        docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) == i).write.parquet(f"{base}/in/part={i}")


def _run_parts(spark, base, found, new, start, batches):
    """Stream the folders ``found``, of which the folders ``new`` have not been read, their files in ``batches`` batches."""
    schema = "doc_id long, text string"
    files = len(spark.read.schema(schema).parquet(f"{base}/in/part={new}").inputFiles())
    lines = ts.line_stream(spark, f"{base}/in/part={found}", fmt="parquet", text_col="text", schema=schema,
                           max_files_per_trigger=-(-files // batches))
    ts.run_until_done(start(ts.stream_words(lines)))


@query("stream_running_count", _WORDS_SQL + """
SELECT word, count(*) AS n, count(*) AS from_batches, 4 AS batches FROM dw GROUP BY word""", ("T01", "T03", "T05"))
def q_stream_running_count(spark, sf):
    """Counts carried over four batches, with a restart from the checkpoint after the second."""
    base = scratch_path(spark, "stream-running")
    _in_parts(spark, sf, base, 4)

    def start(words):
        return ts.start_running_word_count(words, f"{base}/out", f"{base}/ckpt")

    _run_parts(spark, base, "[01]", "[01]", start, 2)
    _run_parts(spark, base, "[0123]", "[23]", start, 2)
    running = spark.read.option("basePath", f"{base}/out/running").schema("word string, n long, batch_id int").parquet(f"{base}/out/running")
    added = spark.read.schema("word string, n long, batch_id int").parquet(f"{base}/out/added")
    batches = running.agg(F.count_distinct("batch_id")).scalar()
    now = running.groupBy("word").agg(F.max("n").alias("n"))
    sums = added.groupBy("word").agg(F.sum("n").alias("from_batches"))
    return now.join(sums, "word").select("word", "n", "from_batches", batches.cast("int").alias("batches"))


@query("stream_memory_sink", _WORDS_SQL + """
SELECT CAST(least(length(word), 64) AS INTEGER) AS letters, count(*) AS n FROM dw GROUP BY 1""", ("K07", "T05"))
def q_stream_memory_sink(spark, sf):
    """Running counts per word length (65 rows at most) in the memory sink, read back as a table."""
    name = "lengths_" + scratch_path(spark, "m").rsplit("-", 1)[1]
    words = ts.stream_words(_doc_lines(spark, sf))
    counts = words.groupBy(F.least(F.length("word"), F.lit(64)).alias("letters")).agg(F.count(F.lit(1)).alias("n"))
    ts.run_until_done(ts.start_append(counts, name, f"{scratch_path(spark, 'stream-memory')}/ckpt", fmt="memory", mode="complete"))
    return spark.table(name)
