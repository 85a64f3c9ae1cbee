"""Exact top-k search by the threshold algorithm over sorted per-dimension lists.

Candidates are dealt into blocks of about ``BLOCK`` rows by a hash of the row,
queries into blocks of ``QUERIES``; every pair of blocks is one task group of
bounded size.  In a group each dimension has a list of the block's rows sorted
by that component.  A query reads its lists from the end that suits the sign of
its own component, a growing stretch at a time; rows met for the first time
are scored in full, and the score that a row met nowhere could still reach - the
sum over dimensions of query component times the component last read - bounds
all others.  Reading stops when the bound is below the kth best score.  The k
best of each block are merged per query.

Scores are exact integers: components are turned into integers first.

Defined cases: a vector that is null or holds a null or non-finite component takes
no part; components past the shorter of two vectors count as 0; ties go to the
smaller id, null ids last; a null id stays null in the result; each query row
leaves out only itself, so a repeated row is a candidate like any other; fewer
candidates than k give fewer rows; empty tables give no rows; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corvid.llm.common import RID, store, with_row_ids

BLOCK = 4096
QUERIES = 4096


def integer_vector(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _exact(values: np.ndarray, other: np.ndarray) -> type:
    """Smallest number type in which all inner products are exact."""
    most = float(np.abs(values).max(initial=0)) * float(np.abs(other).max(initial=0)) * max(1, values.shape[1])
    return np.float64 if most < 2**53 else np.int64 if most < 2**62 else object


def threshold_top(block: np.ndarray, ids: np.ndarray, rows: np.ndarray, query: np.ndarray, own: int, k: int,
                  order: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Positions of the k best rows of a block for one query (score descending, then id, then row).

    ``order`` / ``values``: per dimension the rows in ascending order and their components.
    """
    n = len(block)
    up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)
    met = np.zeros(n, bool)
    met[rows == own] = True
    best_at, best = np.zeros(0, np.int64), np.zeros(0, block.dtype)
    depth, step = 0, 16
    while depth < n:
        stop = min(n, depth + step)
        fresh = np.concatenate([order[depth:stop, up].ravel(), order[n - stop:n - depth, down].ravel()])
        if not len(up) and not len(down):
            fresh, stop = np.arange(n), n          # a query of zeros scores all rows 0
        new = np.zeros(n, bool)
        new[fresh] = True
        new &= ~met
        at = np.flatnonzero(new)
        met[at] = True
        best_at = np.concatenate([best_at, at])
        best = np.concatenate([best, block[at] @ query])
        if len(best) > k:
            cut = np.partition(best, len(best) - k)[len(best) - k] if best.dtype != object else sorted(best)[-k]
            keep = best >= cut
            best_at, best = best_at[keep], best[keep]
        if len(best) >= k and stop < n:
            bound = values[stop - 1, up] @ query[up] + values[n - stop, down] @ query[down]
            if bound < best.min():
                break
        depth, step = stop, step * 2
    take = np.array(sorted(range(len(best)), key=lambda j: (-best[j], ids[best_at[j]], rows[best_at[j]]))[:k], int)
    return best_at[take]


def _dense(cells: pa.ChunkedArray, width: int) -> np.ndarray:
    cells = cells.combine_chunks() if isinstance(cells, pa.ChunkedArray) else cells
    off, flat = np.asarray(cells.offsets), np.asarray(cells.values)
    out = np.zeros((len(cells), width), np.int64)
    size = np.diff(off)
    row = np.repeat(np.arange(len(cells)), size)
    out[row, np.arange(off[0], off[-1]) - np.repeat(off[:-1], size)] = flat[off[0]:off[-1]]
    return out


def top_k(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, id_col, score``: for each query row its k best other rows."""
    rows = (df.select(F.col(id_col).alias("__id"), F.col(vector_col).alias("__v"),
                      F.coalesce(is_query, F.lit(False)).alias("__q"))
            .filter(usable(F.col("__v"))).withColumn("__v", integer_vector(F.col("__v"), scale)))
    rows = store(with_row_ids(rows), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.count_if("__q").alias("q")).first()
    n_blocks, q_blocks = max(1, -(-size["n"] // block)), max(1, -(-size["q"] // queries))
    number = F.xxhash64(RID)
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))
    cand = rows.select(RID, "__id", "__v", F.lit(False).alias("__q"), F.pmod(number, F.lit(n_blocks)).alias("cb"),
                       every(q_blocks).alias("qb"))
    asked = rows.filter("__q").select(RID, "__id", "__v", F.lit(True).alias("__q"), every(n_blocks).alias("cb"),
                                      F.pmod(number, F.lit(q_blocks)).alias("qb"))

    def search(group: pa.Table) -> pa.Table:
        ask = np.asarray(group["__q"])
        named = np.asarray(group["__id"].is_valid())
        ids, rids = np.asarray(group["__id"].fill_null(2**63 - 1)), np.asarray(group[RID])
        width = int(np.diff(np.asarray(group["__v"].combine_chunks().offsets)).max(initial=0))
        vectors = _dense(group["__v"], width)
        cands, qs = np.flatnonzero(~ask), np.flatnonzero(ask)
        kind = _exact(vectors[cands], vectors[qs])
        x, q = vectors[cands].astype(kind), vectors[qs].astype(kind)
        order = np.argsort(x, axis=0, kind="stable")
        values = np.take_along_axis(x, order, axis=0)
        out = []
        for j, row in enumerate(qs):
            best = threshold_top(x, ids[cands], rids[cands], q[j], rids[row], k, order, values)
            score = x[best] @ q[j]
            out += [(int(rids[row]), int(ids[row]) if named[row] else None, int(ids[cands[b]]) if named[cands[b]] else None,
                     int(rids[cands[b]]), int(s)) for b, s in zip(best, score)]
        names = ["q_row", "query_id", "found_id", "found_row", "score"]
        cols = list(zip(*out)) if out else [()] * 5
        return pa.table({name: pa.array(col, pa.int64()) for name, col in zip(names, cols)})

    found = (cand.unionByName(asked).groupBy("cb", "qb")
             .applyInArrow(search, "q_row long, query_id long, found_id long, found_row long, score long"))
    best = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("found_id"), "found_row")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("found_id").alias(id_col), "score"))
