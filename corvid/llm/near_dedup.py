"""Near-duplicate groups by an LSH forest over MinHash signatures.

1. A text's set holds the 64-bit hashes of its distinct five-word shingles;
   equal sets are merged first, so only distinct sets go on.
2. Each set has a signature of 128 minima.  The forest has 32 trees; tree t orders
   signatures by the values from position 4t on.  Each order is sorted by range over
   all executors, so a region of any size lies over as many tasks as it needs.
3. Neighbours in an order are candidates, rated by their longest common prefix; the
   depth adapts by itself, since a set's neighbours in a crowded region share a longer
   prefix than in a sparse one.  A set asks the ``PARTNERS`` sets with which it has the most
   in common over all trees: its candidates grow with the number of trees, never with
   the size of a region.
4. Pairs are confirmed on full sets and contracted to components.
5. A forest finds a pair with high probability only.  So what is still apart is joined
   once more, exactly, by rare-first prefixes
   (:func:`corvid.llm.ngram_join.links`): no pair of two components that reaches
   ``PERCENT`` is left out, whatever the size of its region.

Defined cases: a null, empty or blank text has an empty set and is linked with
nothing; repeated rows are equal sets and so linked; the group is named by its
smallest id (null ids are ignored unless all are null); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm import ngram_join as join
from corvid.llm.common import RID, byte_slices, drop_stored, numbered, store, text_buffer, with_row_ids

SHINGLE = 5
PERCENT = 75
MINIMA = 128
TREES = 32
DEPTH = 8          # values of an order that are compared
PARTNERS = 1
LEAST_COMMON = 6   # values in common over all trees from which a neighbour is asked in the first round

_rng = np.random.default_rng(77)
_XOR = _rng.integers(0, 2**32, MINIMA, dtype=np.uint64).astype(np.uint32)
_MUL = (_rng.integers(0, 2**31, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)


# --- sets and signatures ---------------------------------------------------------

def shingle_sets(data: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text in a buffer."""
    flat, bounds = join.flat_sets(data, off, size)
    return [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """128 minima (uint32) per non-empty set."""
    full = [s for s in sets if len(s)]
    if not full:
        return np.zeros((0, MINIMA), np.uint32)
    flat = np.concatenate(full)
    flat = (flat ^ (flat >> np.uint64(32))).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in full])[:-1]])
    out = np.empty((len(full), MINIMA), np.uint32)
    work = np.empty_like(flat)
    for i in range(MINIMA):
        np.bitwise_xor(flat, _XOR[i], out=work)
        np.multiply(work, _MUL[i], out=work)
        out[:, i] = np.minimum.reduceat(work, starts)
    return out


def tree_orders(signature: np.ndarray) -> np.ndarray:
    """The first ``DEPTH`` values of each set in each tree's order, two to a 64-bit word: (sets, trees, words)."""
    out = np.empty((len(signature), TREES, DEPTH // 2), np.int64)
    for tree in range(TREES):
        at = (np.arange(DEPTH) + tree * (MINIMA // TREES)) % MINIMA
        values = signature[:, at].astype(np.uint64)
        out[:, tree] = ((values[:, 0::2] << np.uint64(32)) | values[:, 1::2]).view(np.int64)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """A fixed-width byte matrix as a binary column."""
    rows = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    off = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(off.tobytes()), pa.py_buffer(rows.tobytes())])


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    data, off = text_buffer(column)
    return data.view(dtype).reshape(len(off) - 1, -1) if len(off) > 1 else np.zeros((0, 1), dtype)


def signed_rows(rows: DataFrame, counted: bool = False) -> DataFrame:
    """``__rid``, ``__id``, number of shingles, digest of the set (null if empty) and signature of numbered rows.

    ``counted``: with ``block`` and ``counts``, null here; besides, rows of these two alone, each task's
    :class:`corvid.llm.ngram_join.SlotCounts`.
    """
    def sign(batches):
        counts = join.SlotCounts() if counted else None

        def signed():
            for batch in batches:
                for part in byte_slices(batch, "__text"):
                    flat, off = join.flat_sets(*text_buffer(part.column("__text")), SHINGLE)
                    if counted:
                        counts.add(flat)
                    sets = [flat[a:b] for a, b in zip(off[:-1], off[1:])]
                    sigs = np.zeros((len(sets), MINIMA), np.uint32)
                    sigs[np.diff(off) > 0] = signatures(sets)
                    digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(RID), part.column("__id"), pa.array(np.diff(off)),
                         pa.array(digest, pa.binary()), _binary(sigs)],
                        names=[RID, "__id", "n_shingles", "digest", "signature"])

        yield from join.with_counts(signed(), counts) if counted else signed()

    rows = rows.select(RID, "__id", "__text")
    return rows.mapInArrow(sign, T.StructType([
        T.StructField(RID, T.LongType()), T.StructField("__id", rows.schema["__id"].dataType), T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()), T.StructField("signature", T.BinaryType()), *(join.COUNTS if counted else [])]))


# --- the forest ------------------------------------------------------------------

_WORDS = [f"k{j}" for j in range(DEPTH // 2)]


def neighbours(signed: DataFrame) -> DataFrame:
    """(``a`` < ``b``, ``common``) of sets side by side in some tree's order; ``common`` sums up their common prefixes."""
    def orders(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                found = tree_orders(_matrix(part.column(1), np.uint32))
                node = np.repeat(np.asarray(part.column(0)), TREES)
                tree = np.tile(np.arange(TREES, dtype=np.int32), part.num_rows)
                words = [pa.array(np.ascontiguousarray(found[:, :, j]).ravel()) for j in range(DEPTH // 2)]
                yield pa.RecordBatch.from_arrays([pa.array(tree), *words, pa.array(node)], names=["tree", *_WORDS, "node"])

    keys = ["tree", *_WORDS, "node"]
    rows = (signed.select("node", "signature")
            .mapInArrow(orders, ", ".join(["tree int", *[f"{w} long" for w in _WORDS], "node long"]))
            .repartitionByRange(*keys).sortWithinPartitions(*keys))

    def side_by_side(batches):
        before = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [np.asarray(c) for c in batch.columns]
            if before is not None:
                cols = [np.concatenate([b, c]) for b, c in zip(before, cols)]
            common = common_prefix(cols[0], cols[1:-1])
            at = np.flatnonzero(common > 0)
            one, two = cols[-1][at], cols[-1][at + 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two)), pa.array(common[at])],
                                             names=["a", "b", "common"])
            before = [c[-1:] for c in cols]

    pairs = rows.mapInArrow(side_by_side, "a long, b long, common long")
    return pairs.groupBy("a", "b").agg(F.sum("common").alias("common"))


def common_prefix(tree: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """How many leading values every row shares with the next one of its tree."""
    out = np.zeros(max(0, len(tree) - 1), np.int64)
    open_ = tree[1:] == tree[:-1]
    for word in words:
        differ = word[1:] ^ word[:-1]
        half = open_ & ((differ >> 32) == 0)
        out += half
        open_ = half & (differ == 0)
        out += open_
    return out


def likeliest(pairs: DataFrame, partners: int = PARTNERS, least: int = LEAST_COMMON) -> DataFrame:
    """Of the pairs (``a``, ``b``, ``common``) each set's ``partners`` with the most in common, ties to the smaller one.

    A set has at most two neighbours a tree, so its list is bounded by the forest.
    """
    pairs = pairs.filter(F.col("common") >= least)
    both = pairs.select(F.col("a").alias("x"), F.struct(-F.col("common"), F.col("b").alias("y")).alias("p")).unionByName(
        pairs.select(F.col("b").alias("x"), F.struct(-F.col("common"), F.col("a").alias("y")).alias("p")))
    best = both.groupBy("x").agg(F.slice(F.sort_array(F.collect_list("p")), 1, partners).alias("p"))
    return (best.select("x", F.explode("p").alias("p")).select("x", F.col("p.y").alias("y"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def linked(rows: DataFrame, signed: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """(``node``, ``component``) of all sets with a confirmed link; the stored signatures are dropped on the way.

    ``counts``: see :func:`corvid.llm.ngram_join.prefixes`.
    """
    nodes = store(signed.select("node"), "forest_nodes")
    asked = store(likeliest(neighbours(signed)), "pairs")
    drop_stored(signed)
    found = join.confirmed(asked, rows, SHINGLE, PERCENT)
    groups = join.links(rows, nodes, SHINGLE, PERCENT, asked, found, early_rounds=1, counts=counts)
    return groups if groups is not None else nodes.select("node", F.col("node").alias("component")).limit(0)


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``__rid, __id, n_shingles, component_id`` (smallest id of the group)."""
    return groups_of(numbered(df, id_col, text_col))


def groups_of(rows: DataFrame) -> DataFrame:
    """:func:`near_groups` of numbered rows (``__rid``, ``__id``, ``__text``) that are stored."""
    everything = store(signed_rows(rows, counted=True), "signatures")
    marks = store(everything.filter("block is null").drop("signature", "block", "counts"), "marks")
    counts = store(everything.filter("block is not null").select("block", "counts"), "slot_counts")
    distinct = (marks.filter("digest is not null").groupBy("digest")
                .agg(F.min(RID).alias("node"), F.min("__id").alias("low"), F.min("n_shingles").alias("n")))
    distinct = store(distinct, "sets_distinct")
    signed = everything.join(distinct.select(F.col("node").alias(RID)), RID, "left_semi").select(F.col(RID).alias("node"), "signature")
    signed = store(signed, "signed")
    drop_stored(everything)
    parts = linked(rows, signed, counts)
    drop_stored(counts)
    named = distinct.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    smallest = named.groupBy("part").agg(F.min("low").alias("component_id"))
    by_set = named.join(smallest, "part").select(F.col("digest").alias("__digest"), "component_id")
    return (marks.join(by_set, F.col("digest") == F.col("__digest"), "left")
            .select(RID, "__id", "n_shingles",
                    F.when(F.col("digest").isNull(), F.col("__id")).otherwise(F.col("component_id")).alias("component_id")))


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay: of each group the one with the smallest id; columns unchanged."""
    rows = store(with_row_ids(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"))), "near_rows")
    names = rows.select(RID, F.struct(F.col("__row")[id_col].alias("i"), F.col(RID).alias("r")).alias("__id"),
                        F.coalesce(F.col("__row")[text_col], F.lit("")).alias("__text"))
    groups = groups_of(names)
    kept = groups.filter(F.col("__id") == F.col("component_id")).select(F.col("__id")["r"].alias(RID))
    return rows.join(kept, RID, "left_semi").select("__row.*")
