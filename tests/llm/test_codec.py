"""SentencePiece codec: round trip, brute-force Viterbi, defined cases."""

import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corvid.llm.q_packing import tokenizer_path
from corvid.llm.sentencepiece_codec import BLANK, codec, decode, encode
from llm_fixtures import docs, package  # noqa: F401

MODEL = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def c():
    return codec(MODEL)


def best_score(c, marked):
    """Greatest sum of scores by plain dynamic programming."""
    best = [0.0]
    for end in range(1, len(marked) + 1):
        options = [best[end - 1] + c.unknown]
        options += [best[start] + c.pieces[marked[start:end]][1] for start in range(max(0, end - 20), end)
                    if marked[start:end] in c.pieces]
        best.append(max(options))
    return best[-1]


def score(c, ids, marked):
    """Sum of scores of an encoding; runs of byte pieces are unknown characters."""
    total, data = 0.0, b""
    by_id = {i: s for i, s in c.pieces.values()}
    for i in ids:
        if i in by_id:
            total += by_id[i]
        else:
            data += c.raw[i]
    return total + c.unknown * len(data.decode())


def test_best_segmentation_equals_brute_force(c):
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("the aing on  étr\n日x1") for _ in range(rng.randint(1, 30)))
        marked = BLANK + text.replace(" ", BLANK)
        ids = np.frombuffer(c.encode(text), "<i4").tolist()
        assert score(c, ids, marked) == best_score(c, marked)
        assert ids == c.segment(marked)             # units in turn equal the whole


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40).filter(lambda t: BLANK not in t))
def test_round_trip(text):
    c = codec(MODEL)
    assert c.decode(np.frombuffer(c.encode(text), "<i4").tolist()) == text


def test_decoder_agrees_with_the_library(c):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in ("Hello  world", " a", "\tx\né 日本", "sentence. Next"):
        assert model.decode(np.frombuffer(c.encode(text), "<i4").tolist()) == text
        assert c.decode(model.encode(text)) == text


def test_frames(docs):
    df = docs([(1, "a b"), (1, "a b"), (2, None), (3, ""), (None, "word " * 30_000), (4, f"x{BLANK}y")]).withColumn("n", F.lit(1))
    out = decode(encode(df, MODEL), MODEL)
    assert out.columns == [*df.columns, "ids", "decoded"]
    got = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert got[(2, None)]["ids"] is None and got[(2, None)]["decoded"] is None
    assert got[(3, "")]["ids"] == [] and got[(3, "")]["decoded"] == ""
    assert got[(4, f"x{BLANK}y")]["decoded"] == "x y"
    assert all(r["decoded"] == t for (i, t), r in got.items() if i != 4)
    assert encode(docs([]), MODEL).count() == 0


def test_clashing_columns_give_way(docs):
    df = docs([(1, "a b"), (2, "c")]).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("z"))
    out = decode(encode(df, MODEL), MODEL)
    assert sorted(out.columns) == sorted(df.columns) and {r["doc_id"]: r["decoded"] for r in out.collect()} == {1: "a b", 2: "c"}
