"""N-gram join: equal to all pairs on fixtures and on a table; groups, lists over tasks, families, defined cases."""

import random
import re

import numpy as np
import pytest
from llm_fixtures import docs, package  # noqa: F401
from pyspark.sql import functions as F

from corvid.llm import ngram_join as J
from corvid.llm.common import numbered, store, table
from corvid.llm.hashing import gram_hashes, word_hashes, words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset([tuple(w)] if w else [])


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, s in enumerate(sets):
        for j in {k for x in s for k in holders[x] if k < i}:
            inter = len(s & sets[j])
            if 100 * inter >= percent * (len(s) + len(sets[j]) - inter):
                a, b = sorted((root(i), root(j)))
                part[b] = a
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return [(d, len(s), low.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def got(df, **kw):
    return sorted(((r["__id"], r["n_shingles"], r["component_id"]) for r in J.jaccard_components(df, **kw).collect()), key=repr)


def varied(seed, n, bases=6, words_most=90, edits=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(3, words_most))] for _ in range(bases)]
    rows = []
    for i in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, edits)):
            text[rng.randrange(len(text))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            text += [rng.choice(vocabulary) for _ in range(rng.randint(1, 6))]
        rows.append((1000 + 7 * ((i * 37) % n), " ".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(docs, seed):
    rows = varied(seed, 150)
    assert got(docs(rows).repartition(7)) == sorted(brute(rows), key=repr)


def test_a_template_with_room_for_few_words(docs):
    """Documents that share most of their words: many just above and just below the threshold."""
    rng = random.Random(8)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(250):
        text = list(base)
        for k in rng.sample(range(120), rng.choice([1, 2, 3, 4, 5])):
            text[k] = f"own{rng.randrange(40)}"
        rows.append((i, " ".join(text)))
    assert got(docs(rows).repartition(6)) == sorted(brute(rows), key=repr)


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()]
    df = table(spark, "/root/testdata/sf0.01", "documents")
    assert got(df) == sorted(brute(rows), key=repr)


def test_groups_of_equal_prefix_and_size(docs, spark):
    """With few counters many prefixes agree, so groups have members that must be told apart."""
    rows = varied(4, 80, bases=2)
    firsts = store(numbered(docs(rows), "doc_id", "text"), "t")
    cut = J.prefixes(firsts, 4, 85).collect()
    for r in cut:
        n = r["n"]
        assert len(r["prefix"]) == (n * 15 // 100 + 1 if n else 0)
    by_key = {}
    for r in cut:
        by_key.setdefault(bytes(r["key"]), set()).add((r["n"], tuple(r["prefix"])))
    assert all(len(v) == 1 for v in by_key.values())


def test_lists_keep_what_is_shared(spark):
    rng = np.random.default_rng(2)
    groups = [(g, 20, [int(x) for x in rng.choice(60, 6, replace=False)]) for g in range(40)]
    df = spark.createDataFrame(groups, "g long, n long, prefix array<long>").repartition(5)
    lists = J.postings(df).collect()
    holders = {}
    for g, _, prefix in groups:
        for s in prefix:
            holders.setdefault(s, set()).add(g)
    kept = {}
    for r in lists:
        kept.setdefault(r["s"], set()).add(r["g"])
        assert r["pg"] is None or (r["pg"] in holders[r["s"]] and r["pg"] != r["g"])
        assert (r["hg"] is None) == (r["pg"] is None) and (r["hg"] is None or r["hg"] in holders[r["s"]])
    assert all(kept[s] == h for s, h in holders.items() if len(h) > 1)
    assert sum(r["pg"] is not None for r in lists) >= sum(len(h) - 1 for h in holders.values()) - 10


def test_a_family_makes_few_pairs(docs, monkeypatch):
    asked = []
    plain = J.confirmed
    monkeypatch.setattr(J, "confirmed", lambda pairs, *a: asked.append(pairs.count()) or plain(pairs, *a))
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(400):
        text = list(base)
        text[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(text)))
    found = got(docs(rows).repartition(4))
    assert {c for _, _, c in found} == {0}
    assert sum(asked) < 400 * 6


def test_defined_cases(docs):
    rows = [(5, None), (4, ""), (3, " \t\n"), (9, "One two"), (2, "one TWO"), (7, "a b c d e f g"), (7, "a b c d e f g"),
            (None, "one two"), (8, "x " * 40_000), (6, "X " * 40_000), (None, "only null here at all")]
    df = docs(rows).withColumn("n", F.lit(1)).withColumn("g", F.lit(2)).withColumn("node", F.lit(3))
    assert got(df) == sorted(brute(rows), key=repr)
    assert got(docs([])) == []


def test_parity_maps_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a = rng.integers(0, 2**63, 300, dtype=np.int64).astype(np.uint64)
        b = np.concatenate([a[:rng.integers(100, 300)], rng.integers(0, 2**63, 40, dtype=np.int64).astype(np.uint64)])
        of = np.repeat(np.arange(2, dtype=np.uint64), [len(a), len(b)])
        x, y = J.parity_maps(np.concatenate([a, b]), of, 2)
        bits = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
        assert 0.5 * len(np.setxor1d(a, b)) < bits <= len(np.setxor1d(a, b))


def test_long_words_of_two_letters_do_not_collide(docs):
    """Thue-Morse words collide under every polynomial modulo 2^64."""
    a, b = "a", "b"
    while len(a) < 2048:
        a, b = a + b, b + a
    assert got(docs([(1, a), (2, b)])) == [(1, 1, 1), (2, 1, 2)]
    data = np.frombuffer(f"{a} {b}".encode(), np.uint8)
    start, end, _ = words(data, np.array([0, len(data)]))
    for which in (0, 1):
        assert len(set(word_hashes(data, start, end, which).tolist())) == 2
    one, two = np.array([1], np.uint64), np.array([2], np.uint64)
    while len(one) < 2048:
        one, two = np.concatenate([one, two]), np.concatenate([two, one])
    assert gram_hashes(one, 2048)[0] != gram_hashes(two, 2048)[0]


def test_wide_maps_never_exceed_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(60):
        a = np.unique(rng.integers(0, 2**63, int(rng.integers(1100, 9000))).astype(np.uint64))
        keep = int(rng.integers(1, len(a)))
        b = np.unique(np.concatenate([a[:keep], rng.integers(0, 2**63, int(rng.integers(1100, 9000))).astype(np.uint64)]))
        x, y = J.wide_map(a), J.wide_map(b)
        assert 2 * len(a) < 8 * len(x) <= 4 * len(a)
        assert J.wide_differing(x, y) == J.wide_differing(y, x) <= len(np.setxor1d(a, b))
        assert J.wide_differing(x, x) == 0


def test_full_sets_of_long_texts_are_asked_for_only_if_they_may_link(spark, docs):
    """Maps of a fixed number of bits let every pair of long texts pass, so that their full sets crossed the shuffle."""
    rng = random.Random(12)
    shared = [f"s{i}" for i in range(40)]
    rows = [(i, " ".join([*shared, *(f"w{rng.randrange(10**6)}" for _ in range(4000))])) for i in range(8)]
    near = rows[0][1].split(" ")
    rows.append((8, " ".join([*near[:3000], "other", *near[3001:]])))
    numbers = store(numbered(docs(rows), "doc_id", "text"), "long_texts")
    members = store(J.prefixes(numbers, 4, 85), "long_members")
    nodes = [r["node"] for r in members.select("node").collect()]
    pairs = spark.createDataFrame([(a, b) for a in nodes for b in nodes if a < b], "a long, b long")
    ids = {r["__rid"]: r["__id"] for r in numbers.collect()}
    asked = [tuple(sorted((ids[r["a"]], ids[r["b"]]))) for r in J.near(pairs, members, 85).collect()]
    assert asked == [(0, 8)]
