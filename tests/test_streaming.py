import os

from pyspark.sql import functions as F

from corvid.plans import stream_queries
from corvid.session import scratch_path
from corvid.streaming import text_streams as ts


def test_per_batch_word_count_no_carry_over(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    for i, text in enumerate(["a b a\n", "a c  \n\n"]):
        p = os.path.join(src, f"f{i}.txt")
        with open(p, "w") as f:
            f.write(text)
        os.utime(p, (1_600_000_000 + i * 100, 1_600_000_000 + i * 100))  # file order = batch order
    base = scratch_path(spark, "t-wc")
    words = ts.stream_words(ts.line_stream(spark, src, fmt="text", max_files_per_trigger=1))
    q = ts.start_batch_word_count(words, f"{base}/out", f"{base}/ckpt")
    ts.run_until_done(q, 120)
    got = {(r.batch_id, r.word): r.n for r in spark.read.parquet(f"{base}/out").collect()}
    # batch 0 = "a b a"; batch 1 = "a c  " (trailing blanks vanish) and "" (one empty word)
    assert got == {(0, "a"): 2, (0, "b"): 1, (1, "a"): 1, (1, "c"): 1, (1, ""): 1}


def test_stop_list_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in2")
    os.makedirs(src)
    with open(os.path.join(src, "f.txt"), "w") as f:
        f.write("good fail sad good\n")
    base = scratch_path(spark, "t-stop")
    kept = ts.stop_list_stream(ts.stream_words(ts.line_stream(spark, src, fmt="text")))
    q = ts.start_append(kept, f"{base}/out", f"{base}/ckpt")
    ts.run_until_done(q, 120)
    assert sorted(r.word for r in spark.read.parquet(f"{base}/out").collect()) == ["good", "good"]


def test_running_count_complete_mode(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in3")
    os.makedirs(src)
    for i in range(2):
        with open(os.path.join(src, f"f{i}.txt"), "w") as f:
            f.write("x y\n")
    words = ts.stream_words(ts.line_stream(spark, src, fmt="text", max_files_per_trigger=1))
    q = (ts.running_word_count(words).writeStream.outputMode("complete").format("memory")
         .queryName("running_wc").option("checkpointLocation", scratch_path(spark, "t-run"))
         .trigger(availableNow=True).start())
    ts.run_until_done(q, 120)
    got = {r.word: r.n for r in spark.sql("select * from running_wc").collect()}
    assert got == {"x": 2, "y": 2}


def _documents(spark, sf, tasks):
    rows = [(i, "good fail\nsad good" if i % 2 else None if i == 4 else f"w{i} good ") for i in range(12)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks).write.parquet(f"{sf}/documents.parquet")


def test_streams_read_a_table_that_is_a_folder(spark, tmp_dir):
    _documents(spark, tmp_dir, 3)
    spark.createDataFrame([(1, "good better")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    kept = {"good": 17, **{f"w{i}": 1 for i in (0, 2, 6, 8, 10)}}
    count = stream_queries.q_stream_word_count(spark, tmp_dir).collect()
    assert {(r.batch_id, r.word): r.n for r in count} == {(0, w): n for w, n in {**kept, "fail": 6, "sad": 6}.items()}
    assert {r.word: r.n for r in stream_queries.q_stream_stop_list(spark, tmp_dir).collect()} == kept
    table = {r.word: r.n for r in stream_queries.q_stream_stop_table(spark, tmp_dir).collect()}
    assert table == {**{w: n for w, n in kept.items() if w != "good"}, "fail": 6, "sad": 6}
    lengths = {r.letters: r.n for r in stream_queries.q_stream_memory_sink(spark, tmp_dir).collect()}
    assert lengths == {4: 17 + 6, 3: 6 + 1, 2: 4}


def test_running_count_takes_parts_of_many_files_in_four_batches(spark, tmp_dir):
    _documents(spark, tmp_dir, 5)
    base = scratch_path(spark, "t-parts")
    stream_queries._in_parts(spark, tmp_dir, base, 4)
    files = [len(spark.read.parquet(f"{base}/in/part={i}").inputFiles()) for i in range(4)]
    assert max(files) > 1 and min(files) > 0                          # not one writer per folder
    assert sorted(r.doc_id for r in spark.read.parquet(f"{base}/in").collect()) == list(range(12))
    got = {r.word: (r.n, r.from_batches, r.batches) for r in stream_queries.q_stream_running_count(spark, tmp_dir).collect()}
    assert got["good"] == (17, 17, 4) and got["fail"] == (6, 6, 4) and got["w8"] == (1, 1, 4) and len(got) == 8
