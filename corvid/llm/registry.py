"""Queries of this subpackage: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

import corvid
from corvid.plans.registry import Builder

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(corvid.__file__)))


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it (a no-op where it is installed)."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            reach_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
