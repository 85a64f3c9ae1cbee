"""Word vectors (skip-gram, hierarchical softmax) whose vocabulary and model are tables.

Spark ML's Word2Vec holds the words, the Huffman codes and both weight matrices on the driver and sends all of
it to every task.  Here the driver holds the Huffman tree by word number (counts, parents and bits, 30 bytes a
word while it is built) and no word and no vector:

* rows are cut into chunks of some million tokens and numbered by a dictionary of their chunk, so that words cross
  a shuffle once a chunk and not once a token;
* the training goes in rounds.  In a round every task trains on tokens of its own, in their order, and holds only the
  vectors of its words and of the tree nodes above them; then the tasks' moves of a vector are put together
  (:func:`_merged`).  A corpus of up to ``lanes * ROUND_TOKENS`` tokens is one round, as in Spark ML
  with one iteration; a larger one has more rounds, each from the vectors of the one before.  A corpus of fewer
  tokens than ``LEAST_TOKENS`` a task is dealt to fewer tasks: what comes together from tasks that saw little has
  hardly moved;
* a row's vector is made with the vectors of its chunk's words.

As in Spark ML: words are numbered by falling count; sentences are cut after 1,000 known words; a word's window reaches
1 to ``window`` words to each side by chance; the rate falls in proportion to the tokens done; a node whose
product with a word is 6 or more moves nothing.  A task moves by ``_STEP`` words at a time: their products
are taken before any of them moves its vectors.

Defined cases: rows without words, or null, take no part and get a zero vector; unknown words (and nulls) count as
zero vectors; words of equal count are numbered in their own order; without any word of ``min_count`` it raises.
"""

from __future__ import annotations

import heapq
import math
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.operators.positions import with_positions
from corvid.operators.vectors import nearest_words
from corvid.session import scratch_path

CHUNK_TOKENS = 4_000_000     # tokens numbered by one dictionary
ROUND_TOKENS = 8_000_000     # tokens a task trains on, at most, before the tasks' vectors are averaged
LEAST_TOKENS = 4_000_000     # and at least, where there are that many
FEW = 100                    # moves of a vector up to which the tasks' moves add up
MERGE_BYTES = 64 << 20       # vectors averaged by one task
SENTENCE = 1000              # known words of a sentence
RATE, LEAST_RATE = 0.025, 1e-4
MAX_EXP = 6.0
_STEP = 4                    # words a task moves by at a time
_BLOCK = 10_000              # tokens prepared at a time, at one learning rate
_SLICE = 1 << 16             # tokens whose vectors are added up at a time
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# ---- stored tables --------------------------------------------------------------------
def _store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back; its shuffles go when it is written."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _drop(df: DataFrame) -> None:
    """Delete the files behind a :func:`_store` table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


# ---- rows in chunks ---------------------------------------------------------------------
@dataclass
class Chunks:
    """Rows with their words as numbers of their chunk's dictionary.

    ``rows``: the other columns, ``__chunk``, ``__row`` and ``__ids`` (int32 values, -1 for a null word);
    ``words``: ``__chunk, __local, word, n``; ``numbers``: the chunks that there are, ``__chunk, __at`` from 0.
    """

    schema: T.StructType
    col: str
    rows: DataFrame
    words: DataFrame
    numbers: DataFrame
    count: int


def _token_runs(batch: pa.RecordBatch, col: str, most: int):
    """The batch in runs of rows of at most ``most`` tokens (one row at least)."""
    lengths = np.asarray(pc.list_value_length(batch.column(col)).fill_null(0), np.int64)
    ends, start = np.cumsum(lengths), 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def chunked(tokens: DataFrame, col: str) -> Chunks:
    spark, limit = tokens.sparkSession, CHUNK_TOKENS
    others = [T.StructField(f.name, f.dataType, True) for f in tokens.schema if f.name != col]
    entry = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())]))
    schema = T.StructType([*others, T.StructField("__chunk", T.LongType()), T.StructField("__row", T.LongType()),
                           T.StructField("__ids", T.BinaryType()), T.StructField("__words", entry)])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        chunk, row, size, known, counts = TaskContext.get().partitionId() << 32, 0, 0, {}, np.zeros(0, np.int64)

        def dictionary():
            entries = pa.StructArray.from_arrays([pa.array(list(known), pa.string()), pa.array(counts[:len(known)])], ["word", "n"])
            lists = pa.ListArray.from_arrays(pa.array([0, len(known)], pa.int32()), entries)
            empty = [pa.nulls(1, f.type) for f in arrow]
            return pa.RecordBatch.from_arrays([*empty[:-4], pa.array([chunk]), *empty[-3:-1], lists.cast(arrow[-1].type)], schema=arrow)

        for whole in batches:
            for batch in _token_runs(whole, col, 1 << 20):
                lists = batch.column(col)
                coded = lists.flatten().dictionary_encode()
                new = np.array([known.setdefault(w, len(known)) for w in coded.dictionary.to_pylist()] + [-1], np.int32)
                ids = new[np.asarray(coded.indices.fill_null(-1), np.int64)]
                if len(known) > len(counts):
                    counts = np.concatenate([counts, np.zeros(2 * len(known) - len(counts), np.int64)])
                counts[:len(known)] += np.bincount(ids[ids >= 0], minlength=len(known))
                lengths = np.asarray(pc.list_value_length(lists).fill_null(0), np.int64)
                ends = pa.py_buffer(np.concatenate([[0], np.cumsum(lengths) * 4]).astype(np.int32))
                packed = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(ids)])
                columns = [batch.column(f.name).cast(arrow.field(f.name).type) for f in others]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.full(batch.num_rows, chunk)), pa.array(np.arange(row, row + batch.num_rows)), packed,
                     pa.nulls(batch.num_rows, arrow[-1].type)], schema=arrow)
                row, size = row + batch.num_rows, size + len(ids)
                if size >= limit:
                    yield dictionary()
                    chunk, size, known, counts = chunk + 1, 0, {}, np.zeros(0, np.int64)
        if row:
            yield dictionary()

    # an empty table has a schema and no rows; a chunk without rows has an empty dictionary
    stored = _store(tokens.mapInArrow(run, schema), "token-chunks")
    rows = stored.filter("__ids is not null").drop("__words")
    words = (stored.filter("__words is not null").select("__chunk", F.posexplode("__words").alias("__local", "__w"))
             .select("__chunk", "__local", "__w.word", "__w.n"))
    found = sorted(r[0] for r in stored.filter("__words is not null").select("__chunk").collect())
    numbers = spark.createDataFrame(list(zip(found, range(len(found)))), "__chunk long, __at int")
    return Chunks(tokens.schema, col, rows, words, numbers, len(found))


# ---- Huffman tree -----------------------------------------------------------------------
def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``parents, bits`` of the words (numbers under ``len(counts)``) and of the inner nodes after them, the last one
    the root (parent -1).  ``counts`` fall; of equal weights a word is taken before a node."""
    v = len(counts)
    weights = array("q", counts.astype(np.int64).tobytes())
    parents, bits = array("i", bytes(4 * (2 * v - 1))), bytearray(2 * v - 1)
    word, node = v - 1, v
    for new in range(v, 2 * v - 1):
        least = []
        for _ in (0, 1):
            if word >= 0 and (node >= new or weights[word] < weights[node]):
                least.append(word)
                word -= 1
            else:
                least.append(node)
                node += 1
        a, b = least
        weights.append(weights[a] + weights[b])
        parents[a] = parents[b] = new
        bits[b] = 1
    out = np.frombuffer(parents, np.int32).copy()
    out[-1] = -1
    return out, np.frombuffer(bytes(bits), np.uint8)


def nodes_above(ids: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """The inner nodes on the ways from the words ``ids`` to the root, sorted."""
    seen = np.zeros(len(parents), bool)
    at = ids
    while len(at):
        up = parents[at]
        up = np.unique(up[up >= 0])
        at = up[~seen[up]]
        seen[at] = True
    return np.flatnonzero(seen)


def paths(ids: np.ndarray, nodes: np.ndarray, parents: np.ndarray, bits: np.ndarray):
    """Ways to the root of the words ``ids``: ``starts`` (one more than words), and for every step the place of its
    node in ``nodes`` and the target 0.5 - bit."""
    at, owner = ids, np.arange(len(ids))
    owners, places, targets = [], [], []
    while len(at):
        up = parents[at]
        keep = up >= 0
        at, up, owner = at[keep], up[keep], owner[keep]
        owners.append(owner.astype(np.int32))
        places.append(np.searchsorted(nodes, up).astype(np.int32))
        targets.append((0.5 - bits[at]).astype(np.float32))
        at = up
    owners = np.concatenate(owners) if owners else np.zeros(0, np.int32)
    order = np.argsort(owners, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(ids)))])
    if not len(order):
        return starts, np.zeros(0, np.int32), np.zeros(0, np.float32)
    return starts, np.concatenate(places)[order], np.concatenate(targets)[order]


# ---- training in a task -------------------------------------------------------------------
def first_vectors(ids: np.ndarray, size: int, seed: int) -> np.ndarray:
    """The untrained vectors of words: from a hash of seed, word number and place, within 0.5 / size of 0."""
    out = np.empty((len(ids), size), np.float32)
    for lo in range(0, len(ids), 8192):
        h = ids[lo:lo + 8192].astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64)
        h += np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
        out[lo:lo + 8192] = ((h >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / np.float32(size)
    return out


def _ragged(starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all steps of the entries ``at`` of ``starts``, and which entry each belongs to."""
    lengths = starts[at + 1] - starts[at]
    owner = np.repeat(np.arange(len(at)), lengths)
    before = np.cumsum(lengths) - lengths
    return np.arange(len(owner)) - before[owner] + starts[at][owner], owner


def move(words: np.ndarray, sentence: np.ndarray, syn0: np.ndarray, syn1: np.ndarray, ways, window: int, rate: float,
         rng: np.random.Generator, moved: tuple[np.ndarray, np.ndarray]) -> None:
    """Train on a block of tokens: ``words`` are places in ``syn0``, ``sentence`` tells sentences apart, ``ways`` is
    :func:`paths`.  Every word is predicted from the vectors of the words around it."""
    starts, places, targets = ways
    n = len(words)
    reach = rng.integers(1, window + 1, n)
    centres, around = [], []
    for d in range(1, min(window, n - 1) + 1):
        near = sentence[d:] == sentence[:-d]
        right, left = np.flatnonzero(near & (reach[:-d] >= d)), np.flatnonzero(near & (reach[d:] >= d))
        centres += [right, left + d]
        around += [words[right + d], words[left]]
    if not centres:
        return
    centre, around = np.concatenate(centres), np.concatenate(around).astype(np.int64)
    if not len(centre):
        return
    step = centre // _STEP
    # the words around and the nodes above the words of a step, each once, and how often they meet which of the words
    key, meets = np.unique(step * len(syn0) + around, return_inverse=True)
    x_rows, x_step = key % len(syn0), key // len(syn0)
    used = np.unique(centre)
    at, owner = _ragged(starts, words[used])
    owner = used[owner]
    key, place = np.unique(owner // _STEP * max(len(syn1), 1) + places[at], return_inverse=True)
    n_rows, n_step = key % max(len(syn1), 1), key // max(len(syn1), 1)
    np.add.at(moved[0], x_rows, np.bincount(meets, minlength=len(x_rows)))
    np.add.at(moved[1], n_rows, np.bincount(place, minlength=len(n_rows)))
    # targets: a line for each node of a step, a column for each of its words; meetings: the other way round
    wanted = np.zeros((len(n_rows), _STEP), np.float32)
    wanted[place, owner % _STEP] = targets[at]
    above = np.abs(wanted)
    steps = np.arange(step.max() + 2)
    x_at, n_at = np.searchsorted(x_step, steps), np.searchsorted(n_step, steps)
    first, wide = x_at[:-1], np.diff(x_at)
    met = np.bincount(_STEP * first[step] + centre % _STEP * wide[step] + meets - first[step],
                      minlength=_STEP * len(x_rows)).astype(np.float32)
    x_at, n_at = x_at.tolist(), n_at.tolist()
    rate, half = np.float32(rate), np.float32(0.5)
    for k in range(len(steps) - 1):
        u, v, q, r = x_at[k], x_at[k + 1], n_at[k], n_at[k + 1]
        if u == v or q == r:
            continue
        i, j, m = x_rows[u:v], n_rows[q:r], met[_STEP * u:_STEP * v].reshape(_STEP, -1)
        x, y = syn0.take(i, 0), syn1.take(j, 0)
        s = y @ x.T.copy()                           # much faster than by the transposed view
        g = above[q:r] @ m
        g *= np.tanh(s * half)
        np.subtract(wanted[q:r] @ m, g, out=g)       # (1 - bit - sigmoid) for every meeting of a node and a word
        np.abs(s, out=s)
        if np.maximum.reduce(s, axis=None) >= MAX_EXP:
            g[s >= MAX_EXP] = 0.0
        g *= rate
        d = g.T @ y
        y += g @ x
        x += d
        syn0[i], syn1[j] = x, y


def train(sentences: list[np.ndarray], syn0, syn1, ways, window: int, rates, rng, moved) -> None:
    """Train on all ``sentences`` in blocks; ``rates(share done)`` is the learning rate."""
    cut = [s[lo:lo + SENTENCE] for s in sentences for lo in range(0, len(s), SENTENCE)]
    total, done, lo = sum(map(len, cut)), 0, 0
    while lo < len(cut):
        hi, size = lo, 0
        while hi < len(cut) and (hi == lo or size + len(cut[hi]) <= _BLOCK):
            size += len(cut[hi])
            hi += 1
        words = np.concatenate(cut[lo:hi])
        move(words, np.repeat(np.arange(hi - lo), [len(s) for s in cut[lo:hi]]), syn0, syn1, ways, window,
             rates(done / total), rng, moved)
        done, lo = done + size, hi


_VECTORS = "key long, vector binary"
_MOVED = _VECTORS + ", weight double"
_GIVEN = ("lane int", "kind int", "a long", "b long", "c long", "data binary")
_ROW, _WORD, _VECTOR = 0, 1, 2


def _binary_rows(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int64) * (matrix.shape[1] * 4)
    data = np.ascontiguousarray(matrix, np.float32)
    return pa.Array.from_buffers(pa.large_binary(), len(matrix), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def _matrix(column, size: int) -> np.ndarray:
    """The float32 vectors of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(np.float32).reshape(-1, size)


def _vector_batches(keys: np.ndarray, matrix: np.ndarray, rows: int = 8192):
    for lo in range(0, len(keys), rows):
        yield pa.RecordBatch.from_arrays([pa.array(keys[lo:lo + rows].astype(np.int64)), _binary_rows(matrix[lo:lo + rows])],
                                         names=["key", "vector"])


def _in_lane(tree, size: int, window: int, seed: int, turn: int, rates):
    """A task of a round: rows, dictionary numbers and vectors of its chunks in, the vectors it moved out."""
    def run(batches):
        parents, bits = tree.value
        rows, numbers, given = [], {}, []
        for batch in batches:
            kind = np.asarray(batch.column(1))
            for k in np.unique(kind):
                part = batch.filter(pa.array(kind == k)) if (kind != k).any() else batch
                if k == _VECTOR:
                    given.append((np.asarray(part.column(2)).copy(), _matrix(part.column(5), size).copy()))
                elif k == _WORD:
                    chunk, local, word = (np.asarray(part.column(i)) for i in (2, 3, 4))
                    for c in np.unique(chunk):
                        here = chunk == c
                        numbers.setdefault(int(c), []).append((local[here], word[here].astype(np.int32)))
                else:
                    rows += zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(5).to_pylist())
        if not numbers:
            return
        ids = np.unique(np.concatenate([w for parts in numbers.values() for _, w in parts]))
        nodes = nodes_above(ids, parents)
        syn0, syn1 = first_vectors(ids, size, seed), np.zeros((len(nodes), size), np.float32)
        while given:
            keys, matrix = given.pop()
            word = keys < len(parents) // 2 + 1
            syn0[np.searchsorted(ids, keys[word])] = matrix[word]
            syn1[np.searchsorted(nodes, keys[~word])] = matrix[~word]
        places = {}
        for c, parts in numbers.items():
            local, word = (np.concatenate(x) for x in zip(*parts))
            places[c] = np.full(local.max() + 2, -1, np.int32)      # the last one for null words
            places[c][local] = np.searchsorted(ids, word)
        del numbers
        rows.sort(key=lambda r: r[:2])
        sentences, nowhere = [], np.full(1, -1, np.int32)
        for c, _, data in rows:
            there = places.get(c, nowhere)
            at = np.frombuffer(data, np.int32)
            found = there[np.where(at < len(there) - 1, at, -1)]
            sentences.append(found[found >= 0])
        del rows
        moved = np.zeros(len(ids), np.float32), np.zeros(len(nodes), np.float32)
        rng = np.random.default_rng([seed % (1 << 32), turn, TaskContext.get().partitionId()])
        train(sentences, syn0, syn1, paths(ids, nodes, parents, bits), window, rates, rng, moved)
        for keys, matrix, which in ((ids, syn0, moved[0]), (nodes, syn1, moved[1])):
            at = np.flatnonzero(which)
            for lo in range(0, len(at), 8192):
                some = at[lo:lo + 8192]
                yield pa.RecordBatch.from_arrays([pa.array(keys[some].astype(np.int64)), _binary_rows(matrix[some]),
                                                  pa.array(which[some].astype(np.float64))], names=["key", "vector", "weight"])
    return run


def _merged(moved: DataFrame, old: DataFrame, size: int, tasks: int) -> DataFrame:
    """The old vector of a key and the tasks' moves, each by its share: the whole move where all tasks together moved
    the vector ``FEW`` times at most, then ever less, down to the mean by how often a task moved it.  Few moves hardly
    meet and add up as they would one after the other; of many, each task's alone go most of the way."""
    def run(batches):
        keys, weights, parts = [], [], []
        for batch in batches:
            keys.append(np.asarray(batch.column(0)).copy())
            parts.append(_matrix(batch.column(1), size).copy())
            weights.append(np.asarray(batch.column(2)).copy())
        if not keys:
            return
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        weights = np.concatenate(weights)
        sums = np.maximum(np.bincount(place, weights=weights, minlength=len(found)), 1e-30)
        share = np.where(weights > 0, np.maximum(weights, np.minimum(sums[place], FEW)) / sums[place], 0.0)
        taken = np.bincount(place, weights=share, minlength=len(found))
        share = np.where(weights > 0, share, 1.0 - taken[place]).astype(np.float32)
        total, at = np.zeros((len(found), size), np.float32), 0
        for part in parts:
            part *= share[at:at + len(part), None]
            np.add.at(total, place[at:at + len(part)], part)
            at += len(part)
        yield from _vector_batches(found, total)

    both = moved.unionByName(old.withColumn("weight", F.lit(0.0)))
    return both.repartition(tasks, "key").mapInArrow(run, _VECTORS)


# ---- the model ----------------------------------------------------------------------------
@dataclass
class WordVectors:
    """Vectors by word as a stored table ``word, vector`` (floats), and how they were made."""

    vectors: DataFrame
    size: int
    partitions: int
    rounds: int
    col: str
    out: str = "vector"

    def getVectors(self) -> DataFrame:
        return self.vectors

    def getNumPartitions(self) -> int:
        return self.partitions

    def findSynonyms(self, word: str, num: int) -> DataFrame:
        """``word, similarity``: the ``num`` words nearest to ``word`` by cosine."""
        if not self.vectors.filter(F.col("word") == word).head(1):
            raise ValueError(f"{word} not in vocabulary")
        table = self.vectors.select("word", F.col("vector").cast("array<double>").alias("vector"))
        return nearest_words(table, [word], num).orderBy("rank").select("word", F.col("cosine").alias("similarity"))

    def transform(self, tokens: DataFrame) -> DataFrame:
        """``tokens`` plus the mean of a row's word vectors."""
        return self.of_chunks(chunked(tokens, self.col))

    def of_chunks(self, chunks: Chunks) -> DataFrame:
        """The rows of ``chunks`` with their mean vectors, stored."""
        size, col, out, limit = self.size, chunks.col, self.out, _SLICE
        fields = [f for f in chunks.schema if f.name != col]
        words = (chunks.words.drop("n").join(self.vectors, "word", "left")
                 .select("__chunk", "__local", F.col("word").alias("__word"), F.col("vector").alias("__vector")))
        both = chunks.rows.unionByName(words, allowMissingColumns=True).join(F.broadcast(chunks.numbers), "__chunk")
        names = both.columns
        schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in chunks.schema],
                               T.StructField(out, T.ArrayType(T.DoubleType()))])

        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema
            arrow, rows, locals_, texts, parts = to_arrow_schema(schema), [], [], [], []
            column = {name: i for i, name in enumerate(names)}
            for batch in batches:
                is_row = batch.column(column["__ids"]).is_valid()
                kept = batch.filter(is_row)
                if kept.num_rows:
                    rows.append(kept)
                entry = batch.filter(pc.invert(is_row))
                if entry.num_rows:
                    vector = entry.column(column["__vector"])
                    matrix = np.zeros((entry.num_rows, size), np.float32)
                    matrix[np.asarray(vector.is_valid())] = np.asarray(vector.drop_null().flatten()).reshape(-1, size)
                    locals_.append(np.asarray(entry.column(column["__local"])).copy())
                    texts.append(entry.column(column["__word"]))
                    parts.append(matrix)
            count = sum(map(len, locals_))
            vectors, order = np.zeros((count + 1, size), np.float32), np.zeros(count, np.int64)   # -1, the last, is a null word
            for lo, at, part in zip(np.cumsum([0, *map(len, locals_)]), locals_, parts):
                vectors[at] = part
                order[at] = np.arange(lo, lo + len(at))
            dictionary = pa.concat_arrays([pa.concat_arrays(texts).take(pa.array(order)), pa.nulls(1, pa.string())]) if texts else pa.nulls(1, pa.string())
            for batch in rows:
                for lo in range(0, batch.num_rows, 1024):
                    part = batch.slice(lo, 1024)
                    ids = [np.frombuffer(x, np.int32) for x in part.column(column["__ids"]).to_pylist()]
                    means = np.zeros((len(ids), size))
                    for i, at in enumerate(ids):
                        for k in range(0, len(at), limit):
                            means[i] += vectors[at[k:k + limit]].sum(axis=0, dtype=np.float64)
                        means[i] *= 1.0 / max(len(at), 1)
                    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                    flat = np.where(flat < 0, count, flat)
                    ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
                    made = {col: pa.ListArray.from_arrays(ends, dictionary.take(pa.array(flat))),
                            out: pa.ListArray.from_arrays(pa.array(np.arange(len(ids) + 1) * size, pa.int32()), pa.array(means.reshape(-1)))}
                    made |= {f.name: part.column(column[f.name]) for f in fields}
                    yield pa.RecordBatch.from_arrays([made[f.name].cast(f.type) for f in arrow], schema=arrow)

        dealt = both.repartitionById(max(chunks.count, 1), F.col("__at"))
        found = _store(dealt.select(*names).mapInArrow(run, schema), "row-vectors")
        return found.select(*[f"`{f.name}`" for f in chunks.schema], array_to_vector(out).alias(out))


def fit(tokens: DataFrame, col: str, size: int, min_count: int, seed: int, max_iter: int, lanes: int,
        window: int = 5, rows: bool = True) -> tuple[WordVectors, DataFrame | None]:
    """The model of all rows' words, and the rows with their vectors if asked for."""
    spark = tokens.sparkSession
    chunks = chunked(tokens, col)
    counts = chunks.words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    vocabulary = with_positions(counts, F.desc("n"), "word", col="id")
    steps = sorted(((r["n"], r["count"]) for r in vocabulary.groupBy("n").count().collect()), reverse=True)
    if not steps:
        raise ValueError(f"no word occurs {min_count} times")
    by_rank = np.repeat(*np.array(steps, np.int64).T)
    v, total = len(by_rank), int(by_rank.sum())
    tree = spark.sparkContext.broadcast(huffman(by_rank))
    del by_rank
    rounds = max(1, math.ceil(total / (lanes * ROUND_TOKENS)))
    members = chunks.words.join(vocabulary.select("word", "id"), "word").select("__chunk", "__local", "id", "n")
    plan = _dealt(spark, members, rounds, lanes, min(lanes, max(1, total // LEAST_TOKENS)))
    members = _store(members.join(F.broadcast(plan), "__chunk").drop("n"), "chunk-words")
    texts = chunks.rows.select("__chunk", "__row", "__ids").join(F.broadcast(plan), "__chunk")
    needed = _store(_needed(members, tree, rounds, lanes), "vectors-needed") if rounds * max_iter > 1 else None
    vectors, stored = spark.range(v).mapInArrow(_untrained(size, seed), _VECTORS), False
    tasks = max(lanes, math.ceil((2 * v + lanes * min(2 * v, ROUND_TOKENS)) * size * 4 / MERGE_BYTES))
    for turn in range(max_iter * rounds):
        number = turn % rounds
        words = members.filter(F.col("round") == number)
        given = [_given(texts.filter(F.col("round") == number), _ROW, "__chunk", "__row", F.lit(None), "__ids"),
                 _given(words, _WORD, "__chunk", "__local", "id", F.lit(None))]
        if turn:
            known = needed.filter(F.col("round") == number).join(vectors, "key")
            given.append(_given(known, _VECTOR, "key", F.lit(None), F.lit(None), "vector"))
        all_given = given[0]
        for more in given[1:]:
            all_given = all_given.unionByName(more)
        turns = max_iter * rounds

        def rates(share, turn=turn, turns=turns):
            return RATE * max(1.0 - (turn + share) / turns, LEAST_RATE)

        dealt = all_given.repartitionById(lanes, F.col("lane"))
        moved = dealt.mapInArrow(_in_lane(tree, size, window, seed, turn, rates), _MOVED)
        after = _store(_merged(moved, vectors, size, tasks), "word-vectors")
        if stored:
            _drop(vectors)
        vectors, stored = after, True
    named = vectors.filter(F.col("key") < v).join(vocabulary.select("word", F.col("id").alias("key")), "key")
    found = _store(named.select("word", "vector").mapInArrow(_as_floats(size), "word string, vector array<float>"), "vectors-by-word")
    if stored:
        _drop(vectors)
    if needed is not None:
        _drop(needed)
    _drop(members)
    tree.unpersist()
    model = WordVectors(found, size, lanes, rounds, col)
    out = model.of_chunks(chunks) if rows else None
    _drop(chunks.rows)
    return model, out


def _dealt(spark: SparkSession, members: DataFrame, rounds: int, lanes: int, used: int) -> DataFrame:
    """``__chunk, round, lane``: chunks of known words dealt to ``used`` tasks of each round, about as many tokens to each."""
    sizes = sorted(((r["n"], r["__chunk"]) for r in members.groupBy("__chunk").agg(F.sum("n").alias("n")).collect()), reverse=True)
    load, dealt = [(0, k) for k in range(rounds * lanes) if k % lanes < used], []
    for n, chunk in sizes:
        have, k = heapq.heappop(load)
        dealt.append((chunk, k // lanes, k % lanes))
        heapq.heappush(load, (have + n, k))
    return spark.createDataFrame(dealt, "__chunk long, round int, lane int")


def _given(df: DataFrame, kind: int, a, b, c, data) -> DataFrame:
    columns = [F.col(x) if isinstance(x, str) else x for x in ("lane", F.lit(kind), a, b, c, data)]
    return df.select(*[x.cast(s.split()[1]).alias(s.split()[0]) for x, s in zip(columns, _GIVEN)])


def _needed(members: DataFrame, tree, rounds: int, lanes: int) -> DataFrame:
    """``key, round, lane``: the words of a task of a round and the nodes above them, each once."""
    def run(batches):
        parents, _ = tree.value
        parts = [(np.asarray(b.column(0)).copy(), np.asarray(b.column(1)).astype(np.int32)) for b in batches]
        if not parts:
            return
        groups, ids = (np.concatenate(x) for x in zip(*parts))
        for group in np.unique(groups):
            words = np.unique(ids[groups == group])
            for keys in (words, nodes_above(words, parents)):
                for lo in range(0, len(keys), 1 << 16):
                    part = keys[lo:lo + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int64)), pa.array(np.full(len(part), group // lanes, np.int32)),
                                                      pa.array(np.full(len(part), group % lanes, np.int32))], names=["key", "round", "lane"])

    group = (F.col("round") * lanes + F.col("lane")).alias("group")
    return (members.select(group, "id").repartitionById(rounds * lanes, F.col("group"))
            .mapInArrow(run, "key long, round int, lane int"))


def _untrained(size: int, seed: int):
    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            for lo in range(0, len(ids), 8192):
                yield from _vector_batches(ids[lo:lo + 8192], first_vectors(ids[lo:lo + 8192], size, seed))
    return run


def _as_floats(size: int):
    def run(batches):
        for batch in batches:
            matrix = _matrix(batch.column(1), size)
            ends = pa.array(np.arange(len(matrix) + 1) * size, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(matrix.reshape(-1)))], names=["word", "vector"])
    return run
