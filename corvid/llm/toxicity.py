"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic rows are the positives; a sample of all training rows, whatever
their label, is the unlabelled set.  Classifiers are linear over word, prefix
and suffix features (present, repeated, or a share of the words); they minimise the class-prior-corrected
risk ``pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))`` with logistic loss, stepping
back when the corrected negative part falls below zero.  ``CLASSIFIERS`` of
them, each on its own share of the unlabelled sample, are averaged.

How much evidence a feature needs is chosen on labelled training rows left out
of a first fit (a quarter of the positives, and rows marked clean); rows marked
clean are otherwise never used as negatives.

Bounds: at most ``POSITIVES`` positive, ``CLEAN`` clean and ``UNLABELLED`` unlabelled rows (those
with the smallest hash of their id) are used for fitting, and only their feature
hashes reach the driver; every row is scored on its whole text.

Defined cases: a null or empty text has no features (its score is that of the
bias); a row without id is never used for fitting and is not held out; an id
with several label rows is toxic if one of them says so, null labels are
ignored; without any confirmed toxic row every score is 0; empty tables give no
rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvid.llm.common import drop_stored, give_memory_back, store

POSITIVES = 2000
UNLABELLED = 3500
FEATURES = 4096
CLEAN = 1000            # rows marked clean, for validation only
EVIDENCE = (4.0, 7.0, 10.0, 14.0, 20.0)   # log-likelihood gains tried for choosing features
CLASSIFIERS = 3
FOLDS = 5
MEMO_WORDS = 400_000


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def word_features(token: str) -> list[int]:
    """Hashes of the word, its prefixes and suffixes (letters only, any case)."""
    word = token.lower().strip("0123456789.,;:!?|()[]{}\"'`*_-+=<>/\\#@&%$~^«»„“”‘’…")
    if not word:
        return []
    names = ["w" + word]
    names += [f"p{word[:n]}" for n in (4, 5, 6) if len(word) > n]
    names += [f"s{word[-n:]}" for n in (4, 5) if len(word) > n]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) for x in names]


def levels(count: int, words: int) -> list[int]:
    """How strongly a word feature shows in a text: occurrences, and share of the words if it repeats."""
    out = [0]
    if count >= 2:
        out += [1] + [2] * (count >= 3) + [3] * (400 * count >= words) + [4] * (150 * count >= words)
    return out


class _Memo(dict):
    """Token -> its feature hashes (only the ``wanted`` ones, if given)."""

    def __init__(self, wanted: set[int] | None = None):
        self.wanted = wanted

    def __missing__(self, token: str) -> tuple:
        found = tuple(h for h in word_features(token) if self.wanted is None or h in self.wanted)
        if len(self) >= MEMO_WORDS:
            self.clear()
        if len(token) <= 64:
            self[token] = found
        return found

    def of(self, text: str | None) -> list[int]:
        """Features of a text: 8 * hash + level."""
        tokens = Counter((text or "").split())
        words, counts = tokens.total(), {}
        for token, n in tokens.items():
            for h in self[token]:
                counts[h] = counts.get(h, 0) + n
        return [8 * h + level for h, n in counts.items() for level in levels(n, words)]


@dataclass
class Model:
    """Feature -> column, and a weight per column and classifier (last row: bias)."""

    columns: dict[int, int]
    weights: np.ndarray
    prior: float

    def probability(self, features: list[int]) -> float:
        if not self.weights.size:
            return 0.0
        at = sorted(self.columns[f] for f in features if f in self.columns)
        z = self.weights[at].sum(axis=0) + self.weights[-1]
        return float((1 / (1 + np.exp(-np.clip(z, -50, 50)))).mean())


def _sample(df: DataFrame, id_col: str, n: int, salt: int) -> DataFrame:
    return df.select(id_col).orderBy(F.xxhash64(F.lit(salt), F.col(id_col)), id_col).limit(n)


def fitting_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_id: str,
                 label_col: str, positives: int, unlabelled: int, clean: int) -> DataFrame:
    """Stored (``positive``, ``unlabelled``, ``clean``, ``features``, ``at``) of the bounded fitting sample; ``at`` numbers the rows."""
    marks = (labels.filter(F.col(label_id).isNotNull() & ~held_out(label_id))
             .groupBy(F.col(label_id).alias("__i")).agg(F.max(label_col).alias("__mark")))
    present = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("__i")).distinct()
    marks = marks.join(present, "__i", "left_semi")
    role = lambda name: [F.lit(int(name == r)).alias(r) for r in ("__pos", "__unl", "__clean")]
    wanted = (_sample(marks.filter("__mark = 1"), "__i", positives, 1).select("__i", *role("__pos"))
              .unionByName(_sample(present, "__i", unlabelled, 2).select("__i", *role("__unl")))
              .unionByName(_sample(marks.filter("__mark = 0"), "__i", clean, 3).select("__i", *role("__clean")))
              .groupBy("__i").agg(*[F.max(r).alias(r) for r in ("__pos", "__unl", "__clean")]))

    def features(batches):
        memo = _Memo()
        for batch in batches:
            rows = [sorted(memo.of(t)) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(rows, pa.list_(pa.int64()))],
                names=["positive", "unlabelled", "clean", "features"])

    # at most POSITIVES + UNLABELLED + CLEAN ids: a proven bound for the broadcast
    picked = (docs.select(F.col(id_col).alias("__d"), F.col(text_col).alias("__t"))
              .join(F.broadcast(wanted), F.col("__d") == F.col("__i")).select("__pos", "__unl", "__clean", "__t"))
    rows = picked.mapInArrow(features, "positive int, unlabelled int, clean int, features array<long>")
    return store(rows.withColumn("at", F.monotonically_increasing_id()), "fitting_rows")


def frequent_only(rows: DataFrame, least: int = 3) -> tuple[pa.Table, np.ndarray]:
    """The fitting rows with those features only that ``least`` positive rows have (no other feature can be chosen),
    and the sorted hashes of these features; ``features`` are places among them.

    Counted and cut by the executors: the driver gets four bytes for a feature that may be chosen, nothing for others.
    """
    counts = rows.filter("positive > 0").select(F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n"))
    hashes = np.sort(counts.filter(F.col("n") >= least).select("f").toArrow().column(0).to_numpy())
    shared = rows.sparkSession.sparkContext.broadcast(hashes)

    def cut(batches):
        hashes = shared.value
        for batch in batches:
            cells = batch.column(3)
            off, flat = np.asarray(cells.offsets), np.asarray(cells.flatten())
            at = np.searchsorted(hashes, flat)
            ok = hashes[np.minimum(at, len(hashes) - 1)] == flat if len(hashes) else np.zeros(len(flat), bool)
            ends = np.concatenate([[0], np.cumsum(ok)])[off - off[0]]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(at[ok].astype(np.int32))),
                 batch.column(4)], names=batch.schema.names)

    return rows.mapInArrow(cut, "positive int, unlabelled int, clean int, features array<int>, at long").toArrow(), hashes


def choose_features(pos: list[np.ndarray], unl: list[np.ndarray], limit: int, evidence: float) -> np.ndarray:
    """Hashes more frequent among positives than among unlabelled rows, by a log-likelihood gain over ``evidence``."""
    hashes, counts = np.unique(np.concatenate([*pos, *unl]), return_counts=True)
    hashes = hashes[counts >= 4]
    if not len(hashes):
        return hashes

    def share(rows):
        flat = np.concatenate(rows)
        at = np.searchsorted(hashes, flat)
        ok = (at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == flat)
        return np.bincount(at[ok], minlength=len(hashes)) / len(rows)

    p, u = share(pos), share(unl)
    both = (p * len(pos) + u * len(unl)) / (len(pos) + len(unl))

    def likelihood(rate, n, given):
        """Log likelihood of a share ``rate`` of ``n`` rows if each has the feature with chance ``given``."""
        given = np.clip(given, 1e-9, 1 - 1e-9)
        return n * (rate * np.log(given) + (1 - rate) * np.log(1 - given))

    gain = (likelihood(p, len(pos), p) - likelihood(p, len(pos), both)
            + likelihood(u, len(unl), u) - likelihood(u, len(unl), both))
    good = (p > 2 * u) & (gain > evidence)
    order = np.argsort(-gain[good], kind="stable")[:limit]
    return np.sort(hashes[good][order])


def _matrix(rows: list[np.ndarray], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the present features."""
    r, c = [], []
    for i, row in enumerate(rows):
        at = np.searchsorted(chosen, row)
        ok = (at < len(chosen)) & (chosen[np.minimum(at, len(chosen) - 1)] == row) if len(chosen) else np.zeros(len(row), bool)
        c.append(at[ok])
        r.append(np.full(int(ok.sum()), i))
    return np.concatenate(r or [np.zeros(0, int)]), np.concatenate(c or [np.zeros(0, int)])


def fit_nnpu(pos: list[np.ndarray], unl: list[np.ndarray], chosen: np.ndarray, prior: float,
             steps: int = 600, rate: float = 0.05, decay: float = 1e-4) -> np.ndarray:
    """Weights (features, then bias) of one classifier: Adam on the non-negative risk, least risk kept."""
    m = len(chosen)
    (pr, pc), (ur, uc) = _matrix(pos, chosen), _matrix(unl, chosen)
    w = np.zeros(m + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    best, least = w.copy(), np.inf

    def margin(r, c, n):
        return np.bincount(r, w[c], n) + w[-1] if len(r) else np.full(n, w[-1])

    def back(r, c, g):
        out = np.bincount(c, g[r], m + 1) if len(c) else np.zeros(m + 1)
        out[-1] += g.sum()
        return out

    for step in range(1, steps + 1):
        zp, zu = margin(pr, pc, len(pos)), margin(ur, uc, len(unl))
        sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
        gp_plus = back(pr, pc, (sp - 1) / len(pos)) * prior          # loss of calling positives positive
        gn = back(ur, uc, su / len(unl)) - prior * back(pr, pc, sp / len(pos))
        negative_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        risk = prior * np.logaddexp(0, -zp).mean() + max(0.0, negative_risk) + decay / 2 * (w[:-1] ** 2).sum()
        if risk < least:
            best, least = w.copy(), risk
        g = gp_plus + gn if negative_risk >= 0 else -gn
        g[:-1] += decay * w[:-1]
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return best


def _ensemble(pos: list, unl: list, prior: float, evidence: float) -> Model:
    chosen = choose_features(pos, unl, FEATURES, evidence)
    order = np.random.default_rng(7).permutation(len(unl))
    weights = [fit_nnpu(pos, [unl[i] for i in order if i % CLASSIFIERS != k] or unl, chosen, prior)
               for k in range(CLASSIFIERS)]
    return Model({int(h): i for i, h in enumerate(chosen)}, np.stack(weights, axis=1), prior)


def _loss(model: Model, pos: list, clean: list) -> float:
    """Mean log loss on rows left out of the fit, classes weighted by the prior."""
    def mean(rows, sign):
        p = np.array([model.probability(row.tolist()) for row in rows])
        return -np.log(np.clip(p if sign else 1 - p, 1e-3, 1)).mean()
    return model.prior * mean(pos, True) + (1 - model.prior) * mean(clean, False)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id: str = "doc_id", label_col: str = "toxic", positives: int = POSITIVES,
        unlabelled: int = UNLABELLED, clean: int = CLEAN) -> Model:
    """Fit on the training folds of ``docs`` and ``labels`` (two tables joined by their ids)."""
    try:
        return _fit(docs, labels, id_col, text_col, label_id, label_col, positives, unlabelled, clean)
    finally:
        give_memory_back()


def _fit(docs, labels, id_col, text_col, label_id, label_col, positives, unlabelled, clean) -> Model:
    known = labels.filter(F.col(label_col).isNotNull() & F.col(label_id).isNotNull() & ~held_out(label_id))
    prior = known.agg(F.avg(F.col(label_col).cast("double")).alias("prior")).first()["prior"] or 0.0
    stored = fitting_rows(docs, labels, id_col, text_col, label_id, label_col, positives, unlabelled, clean)
    rows, hashes = frequent_only(stored)
    drop_stored(stored)
    order = np.argsort(rows.column("at").to_numpy())
    roles = [rows.column(c).to_numpy()[order] for c in ("positive", "unlabelled", "clean")]
    cells = rows.column("features").combine_chunks()
    off, flat = np.asarray(cells.offsets), np.asarray(cells.values)
    each = [flat[off[k]:off[k + 1]] for k in order.tolist()]
    pos, unl, ok = ([x for x, k in zip(each, role) if k] for role in roles)
    if not pos or not unl or not 0 < prior < 1:
        return Model({}, np.zeros((0, CLASSIFIERS)), prior)
    order = np.random.default_rng(11).permutation(len(pos))
    out, keep = [pos[i] for i in order[::4]], [pos[i] for k, i in enumerate(order) if k % 4]
    evidence = EVIDENCE[-1]
    if keep and ok:
        evidence = min(EVIDENCE, key=lambda e: _loss(_ensemble(keep, unl, prior, e), out, ok))
    model = _ensemble(pos, unl, prior, evidence)
    return Model({int(hashes[f]): i for f, i in model.columns.items()}, model.weights, prior)


def with_score(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` plus the score of each whole text; a column that has its name already gives way."""
    df = df.drop(score_col)
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def score(batches):
        model = shared.value
        memo = _Memo({f // 8 for f in model.columns})
        for batch in batches:
            scores = [model.probability(memo.of(t)) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, score_col])

    return df.mapInArrow(score, T.StructType([*df.schema, T.StructField(score_col, T.DoubleType())]))
