"""Every query of the subpackage on the smallest tables; SQL ones against DuckDB."""

import duckdb
import pytest
from llm_fixtures import package  # noqa: F401

import corpus_pipeline
from corvid.llm import catalog

SF_SMALL = "/root/testdata/sf0.001"

COLUMNS = {
    "op1_line_dedup": ["doc_id", "n_lines", "n_removed", "n_runs", "kept_sha256"],
    "op2_minhash_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op3_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op4_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op6_suffix_array_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op7_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op8_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op9_sentencepiece": ["doc_id", "n_ids", "ids_sha256", "decoded_sha256", "round_trip"],
    "op10_threshold_top_k": ["query_id", "rank", "vec_id", "score"],
    "op11_phrase_collocations": ["lang", "rank", "phrase", "a", "l", "r", "n", "score"],
    "op12_ngram_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op13_conversation_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                 "repaired_sha256"],
}


def test_all_are_registered():
    assert sorted(catalog.queries()) == sorted(COLUMNS)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query(spark, name):
    df = catalog.queries()[name](spark, SF_SMALL)
    assert df.columns == COLUMNS[name]
    rows = [tuple(r) for r in df.collect()]
    if name in ("op4_best_fit_packing", "op10_threshold_top_k", "op13_conversation_repair",
                "op11_phrase_collocations"):
        assert rows
    else:
        assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    if name == "op9_sentencepiece":
        assert all(r[-1] for r in rows)
    if sql := catalog.oracle_sql().get(name):
        con = duckdb.connect()
        for t in ("documents", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        cur = con.execute(sql)
        at = [[d[0] for d in cur.description].index(c) for c in df.columns]
        assert sorted(rows) == sorted(tuple(r[i] for i in at) for r in cur.fetchall())


def test_pipeline(spark):
    """Each stage keeps the columns; its decisions equal those of its operator on the stage's own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    schema, counts = docs.schema, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.store(stage(spark, docs, SF_SMALL), f"test_{name}")
        if name == "exact_dedup":
            low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
            best = {}
            for r in docs.select("doc_id", "text").collect():
                key = (r["text"] or "").translate(low)
                best[key] = max(best.get(key, r["doc_id"]), r["doc_id"])
            assert sorted(best.values()) == sorted(r["doc_id"] for r in out.select("doc_id").collect())
        if name != "packing":
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schema]
            counts.append(out.count())
        else:
            pieces = out.groupBy("sequence_id").agg({"length": "sum"}).collect()
            assert max(r[1] for r in pieces) <= 4096
            assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()}
        docs = out
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.7 * counts[0]
    assert corpus_pipeline.run(spark, SF_SMALL).columns[:2] == ["doc_id", "piece"]
