"""Queries without oracle SQL (ML jobs) run on sf0.001 and keep their schema."""

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

ROWS_ONLY = sorted(set(E.queries()) - set(E.oracle_sql()))

EXPECTED_COLUMNS = {
    "tree_forecast": ["artist_id", "plays", "ds"],
    "kmeans": ["vec_id", "cluster", "cost"],
    "spam_score": ["conv_id", "turn", "p_ham", "verdict"],
}


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.count() > 0
    if name in EXPECTED_COLUMNS:
        assert df.columns == EXPECTED_COLUMNS[name]
