"""T01-T05 on Structured Streaming.

* Source: any file source (``text`` lines, or a ``parquet``/``json`` table
  with a text column), or a socket for demos (``source="socket"``).
* T01 word count is **per micro-batch** (no carry-over), as in the
  reference: ``foreachBatch`` aggregates each batch and writes it under
  ``batch_id=<n>`` with overwrite, so a retried batch replaces its own
  output (idempotent).  ``running_word_count`` is the carried-over variant
  (``complete`` mode, state in the checkpoint).
* T02 stop-list filter is a stream-static LEFT ANTI join in ``append`` mode
  into a file sink (exactly-once through the checkpoint); a stop list given
  as a list is a plain predicate.
* Checkpoints and outputs live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corvid.functions.text import STREAM_STOP_LIST, java_split, text_lines
from corvid.operators.text import stop_list_filter


def line_stream(spark: SparkSession, path: str | None = None, fmt: str = "text",
                text_col: str = "value", glob: str | None = None, schema=None,
                host: str | None = None, port: int | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of text lines (column ``line``)."""
    if fmt == "socket":
        raw = spark.readStream.format("socket").option("host", host).option("port", port).load()
        return raw.select(F.col("value").alias("line"))
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.load(path)
    if fmt == "text":
        return raw.select(F.col("value").alias("line"))
    return raw.select(F.explode(text_lines(text_col)).alias("line"))


def stream_words(lines: DataFrame, sep_regex: str = " ") -> DataFrame:
    """Words of each line, split like ``String.split(" ")``."""
    return lines.select(F.explode(java_split("line", sep_regex)).alias("word"))


def _trigger(w, trigger):
    if trigger is None or trigger == "availableNow":
        return w.trigger(availableNow=True)
    return w.trigger(processingTime=trigger)


def start_batch_word_count(words: DataFrame, out_path: str, checkpoint: str,
                           trigger: str | None = None) -> StreamingQuery:
    """T01 + T03 + T05: word counts of each micro-batch, written per batch."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        counts.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    w = words.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def running_word_count(words: DataFrame) -> DataFrame:
    """T01 option: counts carried over between batches (use ``complete`` mode)."""
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def start_running_word_count(words: DataFrame, out_path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """T01 + T03: counts carried over between batches in the state store, and the counts of each batch alone.

    Every batch writes the words it changed: ``n`` up to now under ``running/batch_id=<n>``, and what the batch
    added under ``added/batch_id=<n>``.  A retried batch replaces its own output; a restart from the same
    checkpoint goes on with the state of the last finished batch.
    """
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))

    def per_batch(changed: DataFrame, batch_id: int) -> None:
        changed.persist()
        try:
            changed.write.mode("overwrite").parquet(f"{out_path}/running/batch_id={batch_id}")
            spark = changed.sparkSession
            earlier = _batches_before(spark, f"{out_path}/running", batch_id)
            before = (spark.read.schema("word string, n long").parquet(*earlier) if earlier
                      else spark.createDataFrame([], "word string, n long"))
            known = before.groupBy("word").agg(F.max("n").alias("before"))
            added = (changed.join(known, changed["word"].eqNullSafe(known["word"]), "left")
                     .select(changed["word"], (F.col("n") - F.coalesce("before", F.lit(0))).alias("n")))
            added.write.mode("overwrite").parquet(f"{out_path}/added/batch_id={batch_id}")
        finally:
            changed.unpersist()

    w = counted.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def _batches_before(spark: SparkSession, path: str, batch_id: int) -> list[str]:
    """Folders of the batches before this one that have been written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return [f"{path}/{n}" for n in names if n.startswith("batch_id=") and int(n.split("=")[1]) < batch_id]


def stop_list_stream(words: DataFrame, stop=STREAM_STOP_LIST) -> DataFrame:
    """Words not on the stop list (a list or a table), duplicates kept."""
    return stop_list_filter(words, stop)


def start_append(df: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
                 trigger: str | None = None, mode: str = "append") -> StreamingQuery:
    """Append a stream to a file sink (K07 use ``fmt="console"``/``"memory"``; ``mode="complete"`` for a small table
    of running aggregates, the only thing the memory sink, which lives on the driver, should hold)."""
    w = df.writeStream.outputMode(mode).format(fmt).option("checkpointLocation", checkpoint)
    if fmt not in ("console", "memory"):
        w = w.option("path", out_path)
    elif fmt == "memory":
        w = w.queryName(out_path)
    return _trigger(w, trigger).start()


def run_until_done(q: StreamingQuery, timeout_s: float = 600) -> None:
    """Wait for the query to end (``availableNow``) and surface errors."""
    finished = q.awaitTermination(timeout_s)
    if not finished:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
