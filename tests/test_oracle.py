"""Every registered query with oracle SQL matches DuckDB at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from corvid.sources.tables import TABLE_NAMES

from conftest import SF_SMALL

SQL = E.oracle_sql()
ROWS_ONLY = sorted(set(E.queries()) - set(SQL))


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, rows) == _canon(dcols, cur.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "plays" in df.columns


def test_every_query_has_ids():
    from corvid.plans.registry import REGISTRY
    assert all(e.ids for e in REGISTRY.values())
