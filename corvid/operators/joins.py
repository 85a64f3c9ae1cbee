"""Multi-key and multi-table enrichment joins.

No join is hinted: the planner broadcasts a side only when its byte size is
below the session's limit, and AQE converts or splits from run-time bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def join_on_keys(fact: DataFrame, dim: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on several key columns (e.g. year, month, day)."""
    return fact.join(dim, keys, how)


def enrich(fact: DataFrame, dims: list[tuple[DataFrame, Column | str | list[str]]], how: str = "inner") -> DataFrame:
    """Fact joined with a chain of dimensions, each on its own keys."""
    out = fact
    for dim, on in dims:
        out = out.join(dim, on, how)
    return out


def enrich_where(rows: DataFrame, dim: DataFrame, cond: Column) -> DataFrame:
    """Rows joined with a dimension by a condition, which must hold an equality.

    Without one Spark could only compare every pair of rows; that raises."""
    out = rows.join(dim, cond, "inner")
    plan = out._jdf.queryExecution().sparkPlan().toString()
    if "CartesianProduct" in plan or "NestedLoopJoin" in plan:
        raise ValueError("the join condition has no equality between the two sides")
    return out
