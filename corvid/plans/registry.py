"""A tiny registry: query name -> (Spark builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    build: Builder
    sql: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    """Register a (spark, sf_dir) -> DataFrame builder under ``name``."""
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, ids)
        return fn
    return deco
