"""All registered queries.  Importing this module fills the registry."""

from __future__ import annotations

from corvid.plans import (activity_queries, basic_queries, check_queries, glm_queries, io_queries,  # noqa: F401
                          json_queries, keyed_tree_queries, ml_queries, neural_queries, position_queries,
                          regression_queries, scoring_queries, stream_queries, text_queries,
                          vector_queries)
from corvid.plans.registry import REGISTRY


def queries():
    return {name: e.build for name, e in REGISTRY.items()}


def oracle_sql():
    return {name: e.sql for name, e in REGISTRY.items() if e.sql is not None}
