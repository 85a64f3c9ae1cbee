"""Collocations: equal to counting in plain Python; the trie; runs that spill; defined cases."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_fixtures import docs, package  # noqa: F401

from corvid.llm import collocations as C
from corvid.llm.q_collocations import SQL, op11_phrase_collocations

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=2000):
    """rows: (lang, text)."""
    count, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 6):
                count[lang].update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in count.items():
        kept = {p: a for p, a in f.items() if a >= least}
        held = defaultdict(int)
        for p, a in kept.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    held[p[i:i + size]] = max(held[p[i:i + size]], a)
        found = []
        for p, a in kept.items():
            if len(p) > 1 and not 100 * held[p] >= 100 * a:
                score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def got(df, least, top=2000):
    return sorted(tuple(r) for r in C.ranked(C.collocations(df, least=least), top).collect())


def table(spark, rows):
    return spark.createDataFrame([(x, t, 1, "s") for x, t in rows], "lang string, text string, f int, phrase string").repartition(5)


def prose(seed, n):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "C", "d'", "ß", "Ünder", "e-f", "g", "h", " x"]
    stock = ["a b C d' e-f g", "ß Ünder", "h h h h", "g  a\tb"]
    return [(rng.choice(["en", "de", None]), "".join(rng.choice(stock) + rng.choice([" ", ". ", "\n", " "]) if rng.random() < 0.3 else
                                                     rng.choice(vocabulary) + rng.choice([" ", " ", "  ", ", ", "\x0b"])
                                                     for _ in range(rng.randint(0, 80)))) for _ in range(n)]


@pytest.mark.parametrize("least", [2, 5, 20])
def test_equals_plain_counting(spark, least):
    rows = prose(least, 60)
    assert got(table(spark, rows), least) == brute(rows, least)


def test_top_and_ties(spark):
    rows = prose(11, 60)
    assert got(table(spark, rows), 2, 7) == brute(rows, 2, 7)


def test_query_equals_sql_and_plain_counting(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    rows = sorted(tuple(r) for r in op11_phrase_collocations(spark, sf).collect())
    assert rows and rows == sorted(con.execute(SQL).fetchall())
    plain = con.execute("SELECT lang, text FROM documents").fetchall()
    assert rows == brute(plain, 100)


def test_defined_cases(spark):
    rows = [(None, None), ("und", "a b a b"), (None, "a b"), ("en", ""), ("en", " \t .,"), ("fr", "x y " * 60_000), ("fr", "x y")]
    assert got(table(spark, rows), 2) == brute(rows, 2)
    assert got(table(spark, rows).limit(0), 2) == []


def test_trie_bursts_and_spills_sorted_runs():
    rng = random.Random(1)
    trie, plain, spilt = C.HatTrie(burst=8, limit=300), Counter(), Counter()
    for _ in range(8000):
        key = tuple(rng.randrange(9) for _ in range(rng.randint(1, 5)))
        trie.add(key, 2)
        plain[key] += 2
        if trie.full:
            before = trie.size
            for run in trie.spill():
                assert run == sorted(run)
                spilt.update(dict(run))
            assert trie.size <= 75 < before
    assert any(type(tree[1]) is C._Node for tree in trie.root.values())
    assert trie.size == sum(tree[0] for tree in trie.root.values()) == sum(len(list(C._walk((w,), t[1]))) for w, t in trie.root.items())
    for run in trie.spill(everything=True):
        spilt.update(dict(run))
    assert spilt == plain and trie.size == 0 and not trie.root


def test_runs_survive_packing():
    phrases, counts = [b"a b", b"a b \xc3\xa9", b"b ."], [1, 2**40, 3]
    assert C.opened_run(C.packed_run(phrases, counts)) == (phrases, counts)


def test_numbers_know_only_the_filter():
    known = np.zeros(C.FILTER_BITS // 8, np.uint8)
    h = C.word_key(b"en", b"the") >> C._SHIFT
    known[h >> 3] |= 1 << (h & 7)
    ids = C.Numbers("en", known)
    assert [ids[w] for w in C.tokens(b"the  cat\nthe")] == [2, C.SKIP, C.RARE, C.CUT, 2]
