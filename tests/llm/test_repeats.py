"""Repeated words (op7), bytes (op6) and line runs (op1) against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.llm import line_dedup, substring_dedup, suffix_dedup
from corvid.llm.hashing import BYTE_VALUE, Stretches, words
from corvid.llm.seeds import segments, sliding_min
from llm_fixtures import docs, package  # noqa: F401


def texts(seed, n=40, passage=12):
    rng = random.Random(seed)
    vocabulary = ["ab", "b", "é", "dd", "Ab", "x1", "yy"]
    shared = [[rng.choice(vocabulary) for _ in range(passage)] for _ in range(4)]
    rows = []
    for i in range(n):
        t = [rng.choice(vocabulary) for _ in range(rng.randint(0, 25))]
        if rng.random() < 0.6:
            at = rng.randint(0, len(t))
            t[at:at] = rng.choice(shared)
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(t)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t "), (n + 3, "ab " * 60), (n + 3, "ab " * 60), (None, "q " * 20)]


def brute(units, length):
    count = Counter(tuple(u[i:i + length]) for u in units for i in range(len(u) - length + 1))
    gone = []
    for u in units:
        mask = [False] * len(u)
        for i in range(len(u) - length + 1):
            if count[tuple(u[i:i + length])] > 1:
                mask[i:i + length] = [True] * length
        gone.append(mask)
    return gone


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_words_equal_brute_force(docs, seed):
    rows = texts(seed)
    units = [(t or "").encode().split() for _, t in rows]
    want = sorted((str(i), len(u), sum(m), hashlib.sha256(b" ".join(w for w, g in zip(u, m) if not g)).hexdigest())
                  for (i, _), u, m in zip(rows, units, brute(units, 8)))
    df = docs(rows).withColumn("ranges", F.lit(1)).withColumn("__rid", F.lit(2))
    got = substring_dedup.remove_repeats(df, length=8, gram=3).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want


@pytest.mark.parametrize("seed,hot", [(1, 1000), (2, 1000), (3, 1), (4, 1)])
def test_bytes_equal_brute_force(docs, seed, hot):
    rows = texts(seed)
    units = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), u, m in zip(rows, units, brute(units, 20)):
        runs = sum(1 for j in range(len(m)) if m[j] and (j == 0 or not m[j - 1]))
        want.append((str(i), len(u), sum(m), runs, hashlib.sha256(bytes(b for b, g in zip(u, m) if not g)).hexdigest()))
    df = docs(rows).withColumn("ranges", F.lit(1))
    got = suffix_dedup.remove_repeats(df, length=20, gram=6, hot=hot).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == sorted(want)


def test_empty_tables(docs):
    assert substring_dedup.remove_repeats(docs([])).count() == 0
    assert suffix_dedup.remove_repeats(docs([])).count() == 0
    assert line_dedup.drop_later_runs(docs([])).count() == 0


def test_bounded_prefixes_and_repeats_equal_counting():
    rng = random.Random(9)
    for trial in range(150):
        length, alphabet = rng.choice([3, 5, 9, 12]), b"ab" if trial % 2 else b"abcdefgh\x00"
        base = bytes(rng.choice(alphabet) for _ in range(30))
        segs = list({base[rng.randrange(20):][:rng.randint(1, 20)] + bytes(rng.choice(alphabet) for _ in range(rng.randint(0, 10)))
                     for _ in range(rng.randint(1, 12))})
        copies = np.array([rng.choice([1, 1, 1, 2]) for _ in segs])
        count = Counter()
        for s, c in zip(segs, copies):
            for i in range(len(s) - length + 1):
                count[s[i:i + length]] += c
        want = sorted((k, i) for k, s in enumerate(segs) for i in range(len(s) - length + 1) if count[s[i:i + length]] > 1)
        got = suffix_dedup.repeated_starts(segs, copies, length)
        assert sorted(zip(*(x.tolist() for x in got))) == want


def test_common_prefixes_are_exact_below_the_limit():
    text = np.frombuffer(b"banana bandana cabana", np.uint8).astype(np.int64) + 1
    text = np.append(text, 0)
    sa = suffix_dedup.suffix_array(text, 1, 6)
    lcp = suffix_dedup.bounded_prefixes(text, sa, 6)
    raw = [text[i:].tolist() for i in sa]
    for j in range(1, len(raw)):
        same = next((k for k, (x, y) in enumerate(zip(raw[j - 1], raw[j])) if x != y), 0)
        assert lcp[j] == min(same, 6)


def test_segments_cover_every_window_once():
    rng = np.random.default_rng(2)
    off = np.array([0, 5, 5, 60, 71, 200])
    values = rng.integers(0, 3, 200).astype(np.uint64)
    doc, first, count, place, anchor, content = segments(values, off, 10, 4)
    seen = [(d, w) for d, f, n in zip(doc, first, count) for w in range(f, f + n)]
    assert sorted(seen) == [(d, w) for d in range(5) for w in range(off[d + 1] - off[d] - 9)]
    assert (place >= count - 1).all() and (place <= 6).all()
    assert sliding_min(np.array([5, 3, 4, 1, 6]), 3).tolist() == [3, 1, 1]


def test_words_of_a_buffer():
    data, off = np.frombuffer(b"ab c d", np.uint8), np.array([0, 2, 2, 5, 6])
    start, end, first = words(data, off)
    assert (start.tolist(), end.tolist(), first.tolist()) == ([0, 3, 5], [2, 4, 6], [0, 1, 1, 2, 3])


@pytest.mark.parametrize("run", [1, 2, 3, 4, 5])
def test_line_runs_equal_brute_force(docs, run):
    rng = random.Random(run)
    shared = [[rng.choice("abc") for _ in range(6)] for _ in range(3)]
    rows = []
    for i in range(40):
        lines = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 8))]
        lines[2:2] = rng.choice(shared)[:rng.randint(0, 6)]
        rows.append((i * 7 % 40, "\n".join(lines)))
    rows += [(50, None), (51, ""), (52, "\n\n\n"), (None, "a\na\na\na")]
    df = docs(rows).withColumn("pos", F.lit(1))
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_runs"], r["kept_text"])
           for r in line_dedup.drop_later_runs(df, min_run=run).collect()}
    seen, want = set(), {}
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, x[0])):
        lines = (t or "").split("\n")
        mask = [False] * len(lines)
        for p in range(len(lines) - run + 1):
            window = tuple(lines[p:p + run])
            if window in seen:
                mask[p:p + run] = [True] * run
            seen.add(window)
        runs = sum(1 for j in range(len(mask)) if mask[j] and (j == 0 or not mask[j - 1]))
        want[i] = (len(lines), sum(mask), runs, "\n".join(x for x, m in zip(lines, mask) if not m))
    assert got == want


def brute_lines(rows, least):
    """Every run of every length: later copies of runs with at least ``least`` words go."""
    seen, out = set(), {}
    for i, t in rows:
        lines = (t or "").split("\n")
        mask = [False] * len(lines)
        for p in range(len(lines)):
            for q in range(p + 1, len(lines) + 1):
                if sum(len(x.split()) for x in lines[p:q]) >= least:
                    run = tuple(lines[p:q])
                    if run in seen:
                        mask[p:q] = [True] * (q - p)
                    seen.add(run)
        runs = sum(1 for j in range(len(mask)) if mask[j] and (j == 0 or not mask[j - 1]))
        out[i] = (len(lines), sum(mask), runs, "\n".join(x for x, m in zip(lines, mask) if not m))
    return out


@pytest.mark.parametrize("seed,least", [(1, 1), (2, 4), (3, 7), (4, 12)])
def test_heavy_line_runs_equal_brute_force(docs, seed, least):
    rng = random.Random(seed)
    lines = ["", "", " \t", "a", "b c", "d e f", "one two three four five", "x " * 9]
    stock = [[rng.choice(lines) for _ in range(rng.randint(2, 7))] for _ in range(3)]
    rows = []
    for i in range(30):
        text = [rng.choice(lines) for _ in range(rng.randint(0, 5))]
        text[rng.randint(0, len(text)):0] = rng.choice(stock)
        rows.append((i, "\n".join(text + [f"own{i}"] + (rng.choice(stock) if rng.random() < 0.4 else []))))
    rows += [(40, None), (41, ""), (42, "\n" * 50), (43, "\n" * 50)]
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["n_runs"], r["kept_text"])
           for r in line_dedup.drop_later_runs(docs(rows).repartition(3), min_words=least).collect()}
    assert got == brute_lines(rows, least)


def test_long_lines_go_and_blank_lines_stay(docs):
    long_line = " ".join(f"w{i}" for i in range(120))
    got = {r["doc_id"]: r["kept_text"] for r in line_dedup.drop_later_runs(docs(
        [(1, f"a\n{long_line}\nb"), (2, f"c\n{long_line}\nd"), (3, "c\n\n\nd"), (4, "c\n\n\nd")])).collect()}
    assert got == {1: f"a\n{long_line}\nb", 2: "c\nd", 3: "c\n\n\nd", 4: "c\n\n\nd"}


def test_repeated_rows_are_copies(docs):
    got = line_dedup.drop_later_runs(docs([(1, "a\nb"), (1, "a\nb")]), min_run=2).collect()
    assert sorted(r["n_removed"] for r in got) == [0, 2]


def test_no_task_holds_a_hot_anchor(docs, monkeypatch):
    rng, sizes = random.Random(4), []
    data = np.frombuffer(bytes(rng.choice(b"mnopqrst") for _ in range(20_000)), np.uint8)
    at = np.arange(len(data) - 6)
    low = int(Stretches(BYTE_VALUE[0][data]).hash(at, at + 6).argmin())
    phrase = data[low:low + 6].tobytes().decode()      # of the least hash: the anchor of all windows that hold it
    families = ["".join(rng.choice("abcdefgh") for _ in range(14)) + phrase + "".join(rng.choice("abcdefgh") for _ in range(14))
                for _ in range(30)]
    texts = [f"{rng.randrange(10**6)}{f}{rng.randrange(10**6)}" for f in families for _ in range(2)]
    whole = suffix_dedup.compare

    def counted(pieces, length):
        sizes.append(max([r["count"] for r in pieces.groupBy("a").count().collect()], default=0))
        return whole(pieces, length)

    monkeypatch.setattr(suffix_dedup, "compare", counted)
    got = suffix_dedup.remove_repeats(docs(list(enumerate(texts))), length=20, gram=6, hot=4).collect()
    want = {i: sum(m) for i, m in enumerate(brute([t.encode() for t in texts], 20))}
    assert {r["doc_id"]: r["n_removed"] for r in got} == want and min(want.values()) >= 34
    assert max(sizes) <= 4


def test_windows_of_one_hash_are_told_apart(spark):
    rows = [(1, 1, 5, 10, 0, 1, b"aa"), (1, 1, 5, 11, 3, 1, b"aa"), (1, 1, 5, 12, 0, 1, b"ab"),     # one hash, two contents
            (2, 2, 5, 10, 1, 1, b"cc"), (2, 2, 5, 11, 4, 1, b"cc"), (3, 3, 5, 13, 0, 2, b"dd"), (4, 4, 5, 14, 0, 1, b"ee")]
    rows = [(*r[:6], bytearray(r[6])) for r in rows]
    df = spark.createDataFrame(rows, "h1 long, h2 long, a long, s long, i int, copies long, bytes binary")
    assert sorted(tuple(r) for r in suffix_dedup.equal_windows(df).collect()) == [
        (5, 10, 0), (5, 10, 1), (5, 11, 3), (5, 11, 4), (5, 13, 0)]


def test_windows_with_different_long_words_stay(docs):
    """Thue-Morse words collide under every polynomial modulo 2^64; windows that differ in one of them are no copies."""
    a, b = "a", "b"
    while len(a) < 2048:
        a, b = a + b, b + a
    common = " ".join(f"w{i}" for i in range(34))
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(
        docs([(1, f"{common} {a}"), (2, f"{common} {b}"), (3, f"{common} c"), (4, f"x {common} c")]), with_text=False).collect()}
    assert got == {1: 0, 2: 0, 3: 35, 4: 35}
