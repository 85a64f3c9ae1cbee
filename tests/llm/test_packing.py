"""Packing: ids equal the tokenizer's, places are gapless, the plan holds every piece once."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from corvid.llm.packing import WordIds, fractional, pack, plan, price, slots
from corvid.llm.q_packing import tokenizer_path
from llm_fixtures import docs, package  # noqa: F401

TEXTS = ["Hello, World!!  it's é—x", None, "", "  \t\n", "<|endoftext|> don't 123 ÀÉ ß z", "İstanbul ΟΔΟΣ é",
         "word " * 5000, "x" * 300, "日本語 text\r\nnext", "a\x1cb 'll"]


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return t


def test_words_give_the_tokenizers_ids(tokenizer):
    memo = WordIds(tokenizer_path())
    for t in TEXTS:
        assert np.frombuffer(memo.encode(t or ""), "<u4").tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_places(docs, tokenizer):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3]), (None, "tail")]
    out = pack(docs(rows), tokenizer_path(), capacity=64).collect()
    check_places(out, 64)
    for i, t in enumerate(TEXTS):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        mine = sorted((r for r in out if r["doc_id"] == i), key=lambda r: (r["piece"], r["sequence_id"]))
        if i == 3:
            assert [r["length"] for r in mine] == [1, 1]
            continue
        assert sum((r["ids"] for r in mine), []) == ids
        assert [r["start"] for r in mine] == list(range(0, len(ids), 64))
        for r in mine:
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    assert [r["length"] for r in out if r["doc_id"] is None] == [len(tokenizer.encode("tail", add_special_tokens=False).ids) + 1]


def test_empty_table(docs):
    assert pack(docs([]), tokenizer_path()).count() == 0


def held(configs):
    got = {}
    for config, times in configs:
        for length, copies in config.items():
            got[length] = got.get(length, 0) + copies * times
    return got


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_whole_and_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(np.exp(rng.normal(6.8, 1.1, 20_000)), 1, 4096).astype(int)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    configs = plan(histogram)
    assert held(configs) == histogram
    assert all(sum(l * a for l, a in c.items()) <= 4096 for c, _ in configs)
    used, bound = sum(n for _, n in configs), max(-(-int(lengths.sum()) // 4096), int((lengths > 2048).sum()))
    assert used <= 1.02 * bound + 1


def test_plan_of_large_pieces_only():
    configs = plan({3000: 7, 1096: 3, 2048: 5})
    assert held(configs) == {3000: 7, 1096: 3, 2048: 5} and sum(n for _, n in configs) == 10


def test_three_lengths_that_fit_together():
    """750 sequences would do (150 of four 1000s, 600 of 2 x 683 + 2 x 820 + 1000); 780 are reached."""
    histogram = {683: 1200, 820: 1200, 1000: 1200}
    configs = plan(histogram)
    assert held(configs) == histogram and all(sum(l * a for l, a in c.items()) <= 4096 for c, _ in configs)
    assert sum(n for _, n in configs) <= 780


@pytest.mark.parametrize("low,high", [(600, 1024), (700, 900)])
def test_even_lengths_are_within_a_percent(low, high):
    """The bounds: all tokens over 4096, and (from 683 tokens on) five pieces a sequence at most."""
    lengths = np.random.default_rng(0).integers(low, high + 1, 4200)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    configs = plan(histogram)
    assert held(configs) == histogram
    bound = max(-(-int(lengths.sum()) // 4096), -(-int((lengths >= 683).sum()) // 5))
    assert sum(n for _, n in configs) <= 1.007 * bound


def test_price_is_the_best_knapsack():
    value = np.array([0, 3.0, 4.1, 0, 7.5])
    picked = price(value, 11)
    assert sum(picked) <= 11 and abs(sum(value[s - 1] for s in picked) - max(
        3.0 * a + 4.1 * b + 7.5 * c for a in range(6) for b in range(4) for c in range(3) if 2 * a + 3 * b + 5 * c <= 11)) < 1e-9


def test_fractional_solution_does_not_cover_more_than_needed():
    demand = np.zeros(16)
    demand[[4, 6, 9]] = [30, 20, 10]
    got = np.zeros(16)
    for config, times in fractional(demand, 16):
        for size, copies in config.items():
            got[size - 1] += copies * times
    assert (got <= demand + 1e-6).all() and got.sum() > 0.8 * demand.sum()


def test_slots_number_every_rank_once():
    rows = slots([({5: 2, 3: 1}, 2), ({3: 4}, 1)])
    assert [tuple(r) for r in rows] == [(3, 0, 2, 0, 1, 10), (3, 2, 6, 2, 4, 0), (5, 0, 4, 0, 2, 0)]


def test_printable_chunks_are_split_here(tokenizer):
    text = "(224) 555-4542 a.b68@m9.example.com 4.0. antion,%%% Don't we'Re 'S ''ll Érase"
    memo = WordIds(tokenizer_path())
    memo.tokenizer = None
    assert np.frombuffer(memo.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_word_table_keeps_what_is_in_use(tokenizer, monkeypatch):
    monkeypatch.setattr("corvid.llm.packing.MEMO_WORDS", 2)
    memo = WordIds(tokenizer_path())
    first = memo.encode("alpha beta gamma")
    memo.model = None
    assert memo.encode("alpha beta gamma") == first
    assert sorted(memo) == ["alpha", "beta", "gamma"]
