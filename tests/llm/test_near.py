"""Near-dedup: equal to all-pairs on fixtures, hot groups, regions of any size, defined cases."""

import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm import ngram_join
from corvid.llm.common import RID, connected_components, numbered, store
from corvid.llm.near_dedup import (common_prefix, drop_near_copies, likeliest, linked, near_groups, neighbours, shingle_sets,
                                   signatures, signed_rows)
from llm_fixtures import docs, package  # noqa: F401


def shingles(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(low))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * inter >= 75 * (len(sets[i]) + len(sets[j]) - inter):
                a, b = part[i], part[j]
                part = [min(a, b) if p in (a, b) else p for p in part]
    low = {}
    for p, (i, _) in zip(part, rows):
        low[p] = min(low.get(p, i), i)
    return {i: (len(s), low[p]) for (i, _), s, p in zip(rows, sets, part)}


def varied(seed, n, bases=6, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(8, words))] for _ in range(bases)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        rows.append((1000 + 7 * ((i * 37) % n), " ".join(text) if rng.random() < 0.9 else " ".join(text).upper()))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(docs, seed):
    rows = varied(seed, 120)
    got = {r["__id"]: (r["n_shingles"], r["component_id"]) for r in near_groups(docs(rows)).collect()}
    assert got == brute(rows)


def test_defined_cases(docs):
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "One two"), (2, "one TWO"), (7, "a b c d e f g"), (7, "a b c d e f g"),
            (None, "one two"), (8, "x " * 40_000), (6, "X " * 40_000)]
    got = sorted(((r["__id"], r["n_shingles"], r["component_id"]) for r in near_groups(docs(rows)).collect()), key=repr)
    assert got == sorted([(5, 0, 5), (4, 0, 4), (3, 0, 3), (9, 1, 2), (2, 1, 2), (None, 1, 2), (7, 3, 7), (7, 3, 7),
                          (8, 1, 6), (6, 1, 6)], key=repr)
    assert near_groups(docs([])).count() == 0


def test_one_of_each_group_stays(docs):
    df = docs([(1, "a b c d e f"), (1, "q r s t u v w"), (2, "A b c d e f"), (3, None), (3, None)]).withColumn("node", F.lit(1))
    out = drop_near_copies(df)
    assert out.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted(
        [(1, "a b c d e f"), (1, "q r s t u v w"), (3, None), (3, None)], key=repr)


def test_a_crowded_region_makes_few_pairs_and_stays_whole(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, 400, dtype=np.int64).astype(np.uint64)
    sets = []
    for _ in range(150):
        s = base.copy()
        s[rng.integers(0, 400, 4)] = rng.integers(0, 2**63, 4, dtype=np.int64).astype(np.uint64)
        sets.append(np.unique(s))
    rows = [(i, bytearray(s.tobytes())) for i, s in enumerate(signatures(sets))]
    signed = spark.createDataFrame(rows, "node long, signature binary").repartition(4)
    every = neighbours(signed)
    assert every.count() <= 150 * 32               # one a tree and set, whatever the size of the region
    links = likeliest(every, 2)
    assert links.count() <= 300
    parts = {r["node"]: r["component"] for r in connected_components(links).collect()}
    assert len(parts) == 150 and len(set(parts.values())) <= 3


def test_common_prefixes():
    pack = lambda rows: [np.array([(r[j] << 32 | r[j + 1]) - (1 << 64 if r[j] >> 31 else 0) for r in rows], np.int64) for j in (0, 2)]
    rows = [(1, 2, 3, 4), (1, 2, 3, 4), (1, 2, 3, 9), (1, 2, 2**31 + 5, 9), (1, 7, 2**31 + 5, 9), (8, 7, 1, 1), (8, 7, 1, 1)]
    tree = np.array([0, 0, 0, 0, 0, 0, 1])
    assert common_prefix(tree, pack(rows)).tolist() == [4, 3, 2, 1, 0, 0]


def test_512_sets_of_medium_similarity(docs, monkeypatch):
    """Sets that share a template but do not link: the pairs asked must not grow with the square of their number."""
    asked, plain = [], ngram_join.confirmed
    monkeypatch.setattr(ngram_join, "confirmed", lambda pairs, *a: asked.append(pairs.count()) or plain(pairs, *a))
    template = " ".join(f"t{i}" for i in range(150))
    rows = [(i, template + " " + " ".join(f"o{i}x{j}" for j in range(45))) for i in range(512)]
    got = {r["__id"]: r["component_id"] for r in near_groups(docs(rows).repartition(4)).collect()}
    assert got == {i: i for i in range(512)}
    assert sum(asked) < 2000


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sets_count_words_like_the_pattern():
    texts = ["Á b\x0bc\x85d  e f", "", "one", "A a a a a a a a"]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    sets = shingle_sets(np.frombuffer(b"".join(raw), np.uint8), off)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]


def test_just_similar_pairs_of_a_split_region_are_found(docs):
    template, rows = " ".join(f"t{i}" for i in range(340)), []
    for i in range(200):                           # 0.71 alike; each of the first 20 pairs 0.77
        own = [f"o{i // 2 if i < 40 and j < 20 else 1000 + i}x{j}" for j in range(70)]
        rows.append((i, f"{template} {' '.join(own)}"))
    want = {i: low for i, (_, low) in brute(rows).items()}
    assert len(set(want.values())) == 180
    numbers = numbered(docs(rows), "doc_id", "text")
    ids = {r[RID]: r["__id"] for r in numbers.select(RID, "__id").collect()}
    signed = store(signed_rows(numbers).select(F.col(RID).alias("node"), "signature"), "signed")
    got = {i: i for i in range(200)}
    parts = [(ids[r["node"]], r["component"]) for r in linked(numbers, signed).collect()]
    got.update({i: min(j for j, c in parts if c == part) for i, part in parts})
    assert got == want


def test_long_words_of_two_letters_do_not_link(docs):
    """Thue-Morse words collide under every polynomial modulo 2^64."""
    a, b = "a", "b"
    while len(a) < 2048:
        a, b = a + b, b + a
    got = {r["__id"]: r["component_id"] for r in near_groups(docs([(1, a), (2, b), (3, a)])).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("seed", [5, 6])
def test_small_and_large_regions_lose_no_link(docs, seed):
    rng = random.Random(seed)
    base = [[f"b{k}w{i}" for i in range(100)] for k in range(3)]
    rows = []
    for i in range(220):
        text = list(base[0] if i < 150 else rng.choice(base))
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(100)] = f"e{rng.randrange(60)}"
        rows.append((i, " ".join(text)))
    got = {r["__id"]: (r["n_shingles"], r["component_id"]) for r in near_groups(docs(rows).repartition(5)).collect()}
    assert got == brute(rows)


def test_texts_are_stored_once_and_working_tables_go(docs, monkeypatch):
    """Texts cross the shuffle once a round of pairs, not once a turn; the rows of a pipeline stage are not stored again."""
    made = []

    def noted(df, name):
        made.append((name, store(df, name)))
        return made[-1][1]

    for module in ("common", "near_dedup", "ngram_join"):
        monkeypatch.setattr(f"corvid.llm.{module}.store", noted)
    rows = [(i, " ".join(f"w{i // 3}x{j}" for j in range(40)) + f" o{i}") for i in range(30)] + [(99, None), (None, "")]
    kept = drop_near_copies(docs(rows))
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([*range(0, 30, 3), 99, None], key=str)
    names = [n for n, _ in made]
    assert "rows" not in names and names.count("near_rows") == 1
    assert names.count("join_links") == ngram_join.TURNS * names.count("join_texts")
    for name, df in made:
        if name in ("signatures", "slot_counts", "join_texts", "join_members", "join_lists", "join_beside", "join_links"):
            assert not any(os.path.exists(f.removeprefix("file:")) for f in df.inputFiles()), name


def test_slot_counts_come_with_the_signatures(docs):
    texts = [(i, f"a b c d e f g h{i % 4}") for i in range(20)] + [(77, "")]
    rows = numbered(docs(texts).repartition(3), "doc_id", "text")
    both = store(signed_rows(rows, counted=True), "both")
    assert both.filter("block is null").count() == 21
    assert (ngram_join.rarity(both) == ngram_join.rarity(ngram_join.slot_counts(rows, 5))).all()
