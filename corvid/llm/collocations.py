"""Phrase collocation mining with burst tries.

Phrases of 2 to ``LONGEST`` words are counted per language within pieces (texts cut
at punctuation and line ends); those seen at least ``LEAST`` times are candidates,
scored by how much more often they occur than their two parts would by chance.

1. Words are counted first, then pairs of frequent words, then longer phrases all of
   whose pairs are frequent: a phrase is never more frequent than its parts, so no
   candidate is lost.  What is frequent reaches the tasks as a bit field of
   ``FILTER_BITS`` bits over hashes.  Its size does not grow with the input; a false
   positive costs one counter and changes no result.
2. Within a task a :class:`HatTrie` counts: a shallow trie over word numbers whose
   leaves are hash containers.  A container that holds more than ``BURST`` phrases
   bursts into children by the next word, unless it holds last words only.  Past ``LIMIT`` phrases whole subtrees
   leave as sorted runs, the largest first.
3. Runs are dealt by language and prefix (the first two words) and merged there, so a
   frequent first word burdens no single task.
4. The score of a cut after k words is floor(1000 * a * n / (l * r)) in decimal
   arithmetic of 38 digits (counts up to 10^13); the lowest cut counts.  A candidate is
   dropped if a candidate one word longer that holds it is as frequent: if any longer
   one is, one of these is, too.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated
rows count as often as they occur; words may hold any character but space, tab and the
cutting marks; a text without marks is one piece however long; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvid.llm.common import store, text_buffer
from corvid.llm.hashing import gram_hashes

LEAST = 100
LONGEST = 5
TOP = 2000
SALTS = 64
BURST = 4096
LIMIT = 400_000
PART_PHRASES = 400_000
WORDS = 500_000            # words a task numbers before it starts anew
SLICE = 2 << 20
FILTER_BITS = 1 << 26
_BLOCK_BITS = 1 << 16
_SHIFT = 64 - (FILTER_BITS.bit_length() - 1)

_MARKS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_MARKS + b"\t", b"\n" * len(_MARKS) + b" ")
SKIP, CUT, RARE = -1, 0, 1  # numbers of an empty word, a cut, a word that is not frequent


# --- counting in a task -----------------------------------------------------------------

class HatTrie:
    """Counts of word-number sequences: trie nodes are dicts by word, leaves hash containers of what follows."""

    def __init__(self, burst: int = BURST, limit: int = LIMIT):
        self.burst, self.limit = burst, limit
        self.root: dict[int, list] = {}      # first word -> [phrases in the subtree, node]
        self.size = 0

    def add(self, key: tuple[int, ...], count: int) -> None:
        tree = self.root.get(key[0])
        if tree is None:
            tree = self.root[key[0]] = [0, _Container()]
        node, rest, above = tree[1], key[1:], None
        while type(node) is _Node and rest:
            above, node = node, node.get(rest[0])
            if node is None:
                node = above[rest[0]] = _Container()
            step, rest = rest[0], rest[1:]
        if type(node) is _Node:              # the phrase ends at an inner node
            tree[0] += node.own == 0
            self.size += node.own == 0
            node.own += count
            return
        before = node.get(rest)
        if before is not None:
            node[rest] = before + count
            return
        node[rest] = count
        tree[0] += 1
        self.size += 1
        if len(node) > self.burst and len(rest) > 1:
            grown = _Node()
            for more, n in node.items():
                if not more:
                    grown.own = n
                    continue
                child = grown.get(more[0])
                if child is None:
                    child = grown[more[0]] = _Container()
                child[more[1:]] = n
            if above is None:
                tree[1] = grown
            else:
                above[step] = grown

    def spill(self, everything: bool = False):
        """Leave out whole subtrees, the largest first, until a quarter of the limit is left (or nothing): sorted (key, count)."""
        goal = 0 if everything else self.limit // 4
        for first in sorted(self.root, key=lambda w: -self.root[w][0]):
            if self.size <= goal and not everything:
                break
            count, node = self.root.pop(first)
            self.size -= count
            yield sorted(_walk((first,), node))

    @property
    def full(self) -> bool:
        return self.size > self.limit


class _Node(dict):
    """Word -> child; ``own`` counts the phrase that ends here."""

    __slots__ = ("own",)

    def __init__(self):
        super().__init__()
        self.own = 0


class _Container(dict):
    """The words still to come (a tuple) -> count."""


def _walk(path, node):
    if type(node) is _Container:
        for rest, n in node.items():
            yield path + rest, n
        return
    if node.own:
        yield path, node.own
    for word, child in node.items():
        yield from _walk((*path, word), child)


class Numbers(dict):
    """Word -> number; words the filter does not know are all ``RARE``."""

    def __init__(self, lang: str, known: np.ndarray):
        super().__init__({b"": SKIP, b"\n": CUT})
        self.lang, self.known = lang.encode(), known
        self.words: list[bytes] = [b"", b""]
        self.hashes: list[int] = [0, 0]

    def __missing__(self, word: bytes) -> int:
        h = word_key(self.lang, word)
        number = RARE
        if self.known[h >> _SHIFT >> 3] >> (h >> _SHIFT & 7) & 1:
            number = len(self.words)
            self.words.append(word)
            self.hashes.append(h)
        self[word] = number
        return number


def word_key(lang: bytes, word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8, key=lang[:64]).digest(), "little")


def tokens(data: bytes) -> list[bytes]:
    """Words of prepared bytes, with b"" between neighbouring blanks and a line feed at every cut."""
    return data.replace(b"\n", b" \n ").split(b" ")


def slices(batches, least: int = SLICE):
    """(language, prepared bytes): texts of one language joined by cuts; a long text is cut between its pieces."""
    held: dict[str, list] = {}
    for batch in batches:
        data, off = text_buffer(batch.column(1))
        for row, lang in enumerate(batch.column(0).to_pylist()):
            text = data[off[row]:off[row + 1]].tobytes().lower().translate(_TABLE)
            at = 0
            while len(text) - at > least and (cut := text.find(b"\n", at + least)) >= 0:
                yield lang, text[at:cut]
                at = cut
            parts = held.setdefault(lang, [0, []])
            parts[0] += len(text) - at + 1
            parts[1].append(text[at:])
            if parts[0] >= least:
                yield lang, b"\n".join(held.pop(lang)[1])
    for lang, (_, parts) in held.items():
        yield lang, b"\n".join(parts)


def _run(lang: str, phrases: list[bytes], counts: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()),
                                       pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())],
                                      names=["lang", "phrase", "f"])


_COUNTS = "lang string, phrase string, f long"


def word_counts(rows: DataFrame) -> DataFrame:
    """``lang, phrase, f`` of every word of (``lang``, ``text``) rows."""
    def count(batches):
        held: dict[str, Counter] = {}
        for lang, data in slices(batches):
            found = held.setdefault(lang, Counter())
            found.update(tokens(data))
            if sum(map(len, held.values())) > LIMIT:
                for name in list(held):
                    yield from spilt(name, held.pop(name))
        for name, found in held.items():
            yield from spilt(name, found)

    def spilt(lang, found):
        found.pop(b"", None)
        found.pop(b"\n", None)
        words = sorted(found)
        for lo in range(0, len(words), 10_000):
            yield _run(lang, words[lo:lo + 10_000], [found[w] for w in words[lo:lo + 10_000]])

    return rows.mapInArrow(count, _COUNTS).groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def pair_slots(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Filter bits of word pairs from the words' hashes."""
    both = np.empty(2 * len(first), np.uint64)
    both[0::2], both[1::2] = first, second
    return (gram_hashes(both, 2)[0::2] >> np.uint64(_SHIFT)).astype(np.int64)


def packed_run(phrases: list[bytes], counts: list[int]) -> bytes:
    """A run of phrases and counts, compressed: neighbours in a sorted run share their first words."""
    text = b"\n".join(phrases)
    return zstandard.compress(len(text).to_bytes(8, "little") + text + np.array(counts, "<i8").tobytes(), 1)


def opened_run(run: bytes) -> tuple[list[bytes], list[int]]:
    data = zstandard.decompress(run)
    cut = 8 + int.from_bytes(data[:8], "little")
    return data[8:cut].split(b"\n"), np.frombuffer(data[cut:], "<i8").tolist()


def phrase_counts(rows: DataFrame, least: int, parts: int, words, pairs=None) -> DataFrame:
    """``lang, phrase, f`` from ``least`` on: pairs of words in the filter ``words``, or phrases of 3 and more words all of
    whose pairs are in the filter ``pairs`` (broadcast bit fields); counted over ``parts`` prefix partitions."""
    def count(batches):
        numbers: dict[str, Numbers] = {}
        tries: dict[str, HatTrie] = {}
        for lang, data in slices(batches):
            ids = numbers.setdefault(lang, Numbers(lang, words.value))
            trie = tries.setdefault(lang, HatTrie())
            seq = np.fromiter(map(ids.__getitem__, tokens(data)), np.int64)
            seq = seq[seq != SKIP]
            if pairs is None:
                at = np.flatnonzero((seq[:-1] > RARE) & (seq[1:] > RARE))
                packed, times = np.unique(seq[at] << 32 | seq[at + 1], return_counts=True)
                for a, b, n in zip((packed >> 32).tolist(), (packed & 0xFFFFFFFF).tolist(), times.tolist()):
                    trie.add((a, b), n)
            else:
                for key, n in longer(seq, np.array(ids.hashes, np.uint64), pairs.value).items():
                    trie.add(key, n)
            if trie.full or len(ids) > WORDS:
                yield from runs(lang, trie, ids, len(ids) > WORDS)
                if len(ids) > WORDS:
                    del numbers[lang], tries[lang]
            if sum(t.size for t in tries.values()) > 2 * LIMIT:      # many languages
                for name in list(tries):
                    yield from runs(name, tries.pop(name), numbers.pop(name), True)
        for lang, trie in tries.items():
            yield from runs(lang, trie, numbers[lang], True)

    def runs(lang, trie, ids, everything):
        name, dealt = ids.words, {}
        for run in trie.spill(everything):
            for key, n in run:
                prefix = name[key[0]] + b" " + name[key[1]]
                phrase = prefix if len(key) == 2 else b" ".join([prefix, *[name[i] for i in key[2:]]])
                part = dealt.setdefault(zlib.crc32(prefix) % parts, ([], []))
                part[0].append(phrase)
                part[1].append(n)
        todo = sorted(dealt)
        for lo in range(0, len(todo), 64):
            some = todo[lo:lo + 64]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int64()),
                                              pa.array([packed_run(*dealt.pop(p)) for p in some], pa.binary())],
                                             names=["lang", "part", "run"])

    def merge(batches):
        place, total = None, {}
        for batch in batches:
            for lang, part, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (lang, part) != place:
                    yield from frequent(place, total)
                    place, total = (lang, part), {}
                seen = total.get
                for phrase, n in zip(*opened_run(run.as_buffer())):
                    total[phrase] = seen(phrase, 0) + n
        yield from frequent(place, total)

    def frequent(place, total):
        found = [(p, n) for p, n in total.items() if n >= least]
        if found:
            yield _run(place[0], [p for p, _ in found], [n for _, n in found])

    dealt = rows.mapInArrow(count, "lang string, part long, run binary")
    return dealt.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(merge, _COUNTS)


def longer(seq: np.ndarray, hashes: np.ndarray, known: np.ndarray) -> Counter:
    """Counts of 3 to ``LONGEST`` consecutive words all of whose pairs are in the filter."""
    pair = (seq[:-1] > RARE) & (seq[1:] > RARE)
    at = np.flatnonzero(pair)
    slot = pair_slots(hashes[seq[at]], hashes[seq[at + 1]])
    pair[at] = known[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 != 0
    out: Counter = Counter()
    whole = pair
    for size in range(3, LONGEST + 1):
        whole = whole[:-1] & pair[size - 2:]
        start = np.flatnonzero(whole)
        out.update(zip(*[seq[start + k].tolist() for k in range(size)]))
    return out


def bit_field(phrases: DataFrame, pairs: bool) -> np.ndarray:
    """The filter of the given words or pairs (``lang``, ``phrase``): ``FILTER_BITS`` bits whatever their number."""
    def find(batches):
        for batch in batches:
            langs = [x.encode() for x in batch.column(0).to_pylist()]
            split = [p.encode().split(b" ") for p in batch.column(1).to_pylist()]
            keys = [np.array([word_key(g, w[k]) for g, w in zip(langs, split)], np.uint64) for k in range(1 + pairs)]
            slot = pair_slots(*keys) if pairs else (keys[0] >> np.uint64(_SHIFT)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slot // _BLOCK_BITS), pa.array(slot % _BLOCK_BITS)], names=["block", "bit"])

    slots = phrases.select("lang", "phrase").mapInArrow(find, "block long, bit long").distinct()
    out = np.zeros(FILTER_BITS, bool)
    # at most FILTER_BITS places, block by block
    for r in slots.groupBy("block").agg(F.collect_list("bit").alias("bits")).toLocalIterator():
        out[r["block"] * _BLOCK_BITS + np.array(r["bits"])] = True
    return np.packbits(out, bitorder="little")


# --- scores ---------------------------------------------------------------------------------

def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, n, score`` of the candidates that stay; ``counts``: frequent words and phrases."""
    words = F.split("phrase", " ")
    phrases = counts.withColumn("words", words).withColumn("size", F.size("words"))
    several = phrases.filter("size > 1")
    # candidates one word longer, by the two phrases in them
    inner = several.filter("size > 2").select("lang", "f", F.explode(F.array(
        F.array_join(F.slice("words", F.lit(1), F.col("size") - 1), " "),
        F.array_join(F.slice("words", F.lit(2), F.col("size") - 1), " "))).alias("phrase"))
    swallowed = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    kept = (several.join(swallowed, ["lang", "phrase"], "left").filter("most is null or 100 * most < 100 * f")
            .select("lang", "phrase", F.col("f").alias("a"), "words", "size"))
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ")).withColumn(
        "right", F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " "))
    known = counts.select("lang", "phrase", "f")
    cuts = (cuts.join(known.toDF("lang", "left", "l"), ["lang", "left"]).join(known.toDF("lang", "right", "r"), ["lang", "right"])
            .join(totals, "lang"))
    score = F.expr("(cast(1000 as decimal(4,0)) * cast(a as decimal(13,0)) * cast(n as decimal(15,0)))"
                   " div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min_by(F.struct("a", "l", "r", "n", "score"), F.struct("score", "k")).alias("best"))
    return best.select("lang", "phrase", "best.*")


def ranked(rows: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each language by score, then count, then phrase in byte order, with ``rank`` from 1."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    return (first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> DataFrame:
    """Every candidate that stays with its counts and score (unranked): ``lang, phrase, a, l, r, n, score``."""
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = store(word_counts(rows), "phrase_words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.filter(F.col("f") >= least)
    word_field = spark.sparkContext.broadcast(bit_field(frequent, False))
    parts = 1 + (totals.agg(F.sum("n")).first()[0] or 0) // PART_PHRASES
    pairs = store(phrase_counts(rows, least, parts, word_field), "phrase_pairs")
    pair_field = spark.sparkContext.broadcast(bit_field(pairs, True))
    more = phrase_counts(rows, least, parts, word_field, pair_field)
    counts = store(frequent.unionByName(pairs).unionByName(more), "phrase_counts")
    return scored(counts, totals)
