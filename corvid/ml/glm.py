"""Gamma regression with a search over penalties, and collinear columns dropped.

* The Gram matrix (sums, squares and products of all columns) comes from one
  aggregation with a map-side combine; from there on only a k x k matrix is used.
* Dependent columns are those whose pivot in a Cholesky factorisation of the correlation
  matrix vanishes: going through the columns in the given order, one that the kept ones
  before it explain up to ``TOLERANCE`` of its variance is dropped.
* The fit is by iteratively reweighted least squares: one aggregation (a weighted Gram
  matrix) per step, solved on the driver.  The penalty path goes from large to small and
  each fit starts from the last one's coefficients.
* The link is the family's own (inverse) unless log or identity is asked for.
* The penalty with the least deviance on the held-out rows (a hash of the key) is chosen.

Penalties apply to standardised columns, never to the intercept: the fit minimises
deviance / (2 n) + penalty / 2 * sum of squared standardised coefficients.

Defined cases: rows with a null or NaN in a used column, or a label that is not
positive, take no part; a constant column is dropped; no rows at all raises.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-9
LINKS = ("inverse", "log", "identity")
PENALTIES = (1.0, 0.3, 0.1, 0.03, 0.01, 0.003, 0.001, 0.0)


@dataclass
class Gram:
    """Sums over rows: count, column means, centred products (sums, not averages)."""

    columns: list[str]
    n: int
    means: np.ndarray
    products: np.ndarray
    raw: np.ndarray = field(repr=False)

    @property
    def deviations(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.products), 0.0) / max(self.n, 1))


def _complete(df: DataFrame, columns: list[str], label: str | None = None) -> DataFrame:
    rows = df
    for c in [*columns, *([label] if label else [])]:
        rows = rows.filter(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    return rows.filter(F.col(label) > 0) if label else rows


def gram_entries(df: DataFrame, columns: list[str]) -> DataFrame:
    """``a, b, product``: sums of products of every two columns (a not after b), by column name, from one aggregation."""
    rows = _complete(df, columns)
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    x = [F.col(c).cast("double") for c in columns]
    sums = rows.agg(*[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs])
    entries = F.array(*[F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), F.col(f"p{i}_{j}").alias("product"))
                        for i, j in pairs])
    return sums.select(F.explode(entries).alias("e")).select("e.*")


def gram(df: DataFrame, columns: list[str]) -> Gram:
    """The Gram matrix of complete rows, shifted by the columns' means before products are summed."""
    rows, k = _complete(df, columns), len(columns)
    first = rows.agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    if not first["n"]:
        raise ValueError("no complete rows")
    means = np.array([first[f"m{i}"] for i in range(k)])
    x = [F.col(c).cast("double") - float(means[i]) for i, c in enumerate(columns)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = rows.agg(*[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs]).first()
    products = np.zeros((k, k))
    for i, j in pairs:
        products[i, j] = products[j, i] = sums[f"p{i}_{j}"]
    return Gram(list(columns), first["n"], means, products, products + first["n"] * np.outer(means, means))


def independent_columns(g: Gram, tolerance: float = TOLERANCE) -> list[str]:
    """The columns that stay, in their order."""
    scale = np.sqrt(np.maximum(np.diag(g.products), 0.0))
    kept: list[int] = []
    factor = np.zeros((0, len(scale)))
    for j in range(len(scale)):
        if scale[j] <= 0 or scale[j] ** 2 <= tolerance * max(g.raw[j, j], 1e-300):
            continue
        row = g.products[j] / (scale[j] * np.where(scale > 0, scale, 1.0)) - factor[:, j] @ factor
        if row[j] <= tolerance:
            continue
        factor = np.vstack([factor, row / np.sqrt(row[j])])
        kept.append(j)
    return [g.columns[j] for j in kept]


@dataclass
class GammaFit:
    """One point of the path."""

    penalty: float
    columns: list[str]
    coefficients: np.ndarray
    intercept: float
    link: str
    steps: int
    deviance: float = float("nan")
    held_out: float = float("nan")

    def eta(self) -> Column:
        total = F.lit(float(self.intercept))
        for c, b in zip(self.columns, self.coefficients):
            total = total + F.lit(float(b)) * F.col(c).cast("double")
        return total

    def mean(self) -> Column:
        return _mean(self.eta(), self.link)


def _mean(eta: Column, link: str) -> Column:
    """Fitted mean; a linear predictor outside the link's range is held at its edge."""
    if link == "log":
        return F.exp(F.least(eta, F.lit(700.0)))
    safe = F.greatest(eta, F.lit(1e-9))
    return F.lit(1.0) / safe if link == "inverse" else safe


def _working(eta: Column, mu: Column, y: Column, link: str) -> tuple[Column, Column]:
    """Weight and working response of gamma regression."""
    if link == "log":
        return F.lit(1.0), eta + (y - mu) / mu
    if link == "inverse":
        return mu * mu, eta - (y - mu) / (mu * mu)
    return F.lit(1.0) / (mu * mu), eta + (y - mu)


def deviance(df: DataFrame, label: str, mean: Column) -> tuple[float, int]:
    """Summed gamma deviance and the number of rows."""
    y = F.col(label).cast("double")
    r = df.agg(F.sum(2 * (y / mean - 1 - F.log(y / mean))).alias("d"), F.count(F.lit(1)).alias("n")).first()
    return r["d"] or 0.0, r["n"]


def fit_gamma(rows: DataFrame, g: Gram, label: str, columns: list[str], penalty: float, link: str = "inverse",
              start: GammaFit | None = None, most: int = 50, tolerance: float = 1e-10) -> GammaFit:
    """One fit by reweighted least squares on standardised columns, from ``start`` or the mean."""
    if link not in LINKS:
        raise ValueError(f"link {link!r} is none of {LINKS}")
    at = [g.columns.index(c) for c in columns]
    means, scale = g.means[at], g.deviations[at]
    y = F.col(label).cast("double")
    if start is None:
        mean = rows.agg(F.avg(y)).first()[0]
        intercept = {"log": np.log(mean), "inverse": 1.0 / mean, "identity": mean}[link]
        beta = np.zeros(len(columns))                  # on standardised columns
    else:
        beta = start.coefficients * scale
        intercept = start.intercept + float(start.coefficients @ means)
    x = [F.lit(1.0), *[(F.col(c).cast("double") - float(m)) / float(s) for c, m, s in zip(columns, means, scale)]]
    pairs = [(i, j) for i in range(len(x)) for j in range(i, len(x))]
    steps = 0
    for steps in range(1, most + 1):
        eta = F.lit(float(intercept))
        for b, c in zip(beta, x[1:]):
            eta = eta + F.lit(float(b)) * c
        mu = _mean(eta, link)
        w, z = _working(eta, mu, y, link)
        work = rows.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], w.alias("w"), z.alias("z"))
        sums = work.agg(*[F.sum(F.col("w") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}_{j}") for i, j in pairs],
                        *[F.sum(F.col("w") * F.col(f"x{i}") * F.col("z")).alias(f"r{i}") for i in range(len(x))]).first()
        a = np.zeros((len(x), len(x)))
        for i, j in pairs:
            a[i, j] = a[j, i] = sums[f"p{i}_{j}"] / g.n
        r = np.array([sums[f"r{i}"] for i in range(len(x))]) / g.n
        a[np.arange(1, len(x)), np.arange(1, len(x))] += penalty
        new = np.linalg.solve(a, r)
        change = np.max(np.abs(new - np.concatenate([[intercept], beta])) / (np.abs(new) + 1e-12) * (np.abs(new) > 1e-12))
        intercept, beta = new[0], new[1:]
        if change < tolerance:
            break
    coefficients = beta / scale
    return GammaFit(penalty, list(columns), coefficients, float(intercept - coefficients @ means), link, steps)


def gamma_path(df: DataFrame, label: str, columns: list[str], key: str, link: str = "inverse",
               penalties=PENALTIES, train_percent: int = 80) -> tuple[GammaFit, list[GammaFit], list[str]]:
    """(the chosen fit, the whole path, the dropped columns)."""
    from corvid.ml.models import hash_split
    rows = _complete(df, columns, label)
    train, test = hash_split(rows, key, train_percent)
    train = train.select(label, *columns).persist()
    test = test.select(label, *columns).persist()
    try:
        g = gram(train, columns)
        kept = independent_columns(g)
        path, last = [], None
        for penalty in sorted(penalties, reverse=True):
            last = fit_gamma(train, g, label, kept, penalty, link, last)
            total, n = deviance(train, label, last.mean())
            last.deviance = total / n
            total, n = deviance(test, label, last.mean())
            last.held_out = total / n if n else float("nan")
            path.append(last)
    finally:
        train.unpersist()
        test.unpersist()
    best = min(path, key=lambda f: (f.held_out if f.held_out == f.held_out else f.deviance, -f.penalty))
    return best, path, [c for c in columns if c not in kept]
