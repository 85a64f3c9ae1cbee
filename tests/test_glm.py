"""Gamma regression against a dense numpy fit; dependent columns; the path."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.ml import glm


def sample(spark, link):
    df = spark.range(800).select("id", ((F.col("id") * 7919) % 101 / 100.0).alias("x"), ((F.col("id") * 104729) % 53 / 52.0).alias("z"))
    eta = 0.8 + 0.6 * F.col("x") - 0.3 * F.col("z")
    mu = {"log": F.exp(eta), "inverse": 1 / eta, "identity": eta}[link]
    noise = 0.6 + 0.8 * ((F.col("id") * 15485863) % 97 / 96.0)
    return df.withColumn("y", mu * noise).withColumn("twice", 2 * F.col("x") - F.col("z") + 5).withColumn("flat", F.lit(3.0)).repartition(5)


def dense(x, y, penalty, link):
    """Newton's method on the penalised deviance of standardised columns."""
    mean, scale = x.mean(0), x.std(0)
    a = np.column_stack([np.ones(len(y)), (x - mean) / scale])
    b = np.zeros(a.shape[1])
    b[0] = {"log": np.log(y.mean()), "inverse": 1 / y.mean(), "identity": y.mean()}[link]
    ridge = np.diag([0.0] + [penalty] * x.shape[1])
    for _ in range(200):
        eta = a @ b
        mu = {"log": np.exp(eta), "inverse": 1 / eta, "identity": eta}[link]
        slope = {"log": mu, "inverse": -mu ** 2, "identity": np.ones_like(mu)}[link]      # d mu / d eta
        w, z = slope ** 2 / mu ** 2, eta + (y - mu) / slope
        b = np.linalg.solve(a.T @ (a * w[:, None]) / len(y) + ridge, a.T @ (w * z) / len(y))
    coefficients = b[1:] / scale
    return b[0] - coefficients @ mean, coefficients


@pytest.mark.parametrize("link", glm.LINKS)
@pytest.mark.parametrize("penalty", [0.0, 0.05])
def test_fit_equals_a_dense_fit(spark, link, penalty):
    df = sample(spark, link)
    rows = np.array(df.select("x", "z", "y").collect(), float)
    fit = glm.fit_gamma(df, glm.gram(df, ["x", "z"]), "y", ["x", "z"], penalty, link)
    intercept, coefficients = dense(rows[:, :2], rows[:, 2], penalty, link)
    assert abs(fit.intercept - intercept) < 1e-6 and np.abs(fit.coefficients - coefficients).max() < 1e-6


def test_dependent_and_constant_columns_go(spark):
    df = sample(spark, "log")
    g = glm.gram(df, ["x", "flat", "z", "twice"])
    assert glm.independent_columns(g) == ["x", "z"]
    assert glm.independent_columns(glm.gram(df, ["twice", "z", "x"])) == ["twice", "z"]
    x = np.array(df.select("x", "z").collect(), float)
    assert np.allclose(glm.gram(df, ["x", "z"]).raw, x.T @ x)


def test_path_chooses_by_held_out_rows_and_starts_warm(spark):
    df = sample(spark, "inverse").unionByName(spark.createDataFrame([(9001, None, 1.0, 1.0, 1.0, 3.0), (9002, 1.0, 1.0, -4.0, 1.0, 3.0)],
                                                                     "id long, x double, z double, y double, twice double, flat double"))
    best, path, dropped = glm.gamma_path(df, "y", ["x", "z", "twice", "flat"], "id", penalties=(0.5, 0.05, 0.0))
    assert dropped == ["twice", "flat"] and [f.penalty for f in path] == [0.5, 0.05, 0.0]
    assert best.held_out == min(f.held_out for f in path) and best.link == "inverse"
    assert path[0].deviance > path[-1].deviance
    cold = glm.fit_gamma(glm._complete(df, ["x", "z"], "y"), glm.gram(df, ["x", "z"]), "y", ["x", "z"], 0.05)
    assert path[1].steps <= cold.steps + 1
    with pytest.raises(ValueError):
        glm.gamma_path(df.limit(0), "y", ["x"], "id")
    with pytest.raises(ValueError):
        glm.fit_gamma(df, glm.gram(df, ["z"]), "y", ["z"], 0.0, "probit")
