"""Plan-shape assertions: the plans we want at scale."""

import __spark_entry__ as E
from corvid.operators.shape import explain_text

from conftest import SF_SMALL


def test_daily_activity_scans_fact_once_and_aggregates_by_hash(spark):
    plan = explain_text(E.queries()["daily_activity"](spark, SF_SMALL))
    assert plan.count("lineitem.parquet") == 1
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_forecast_dates_shuffles_activity_once_by_artist(spark):
    plan = explain_text(E.queries()["forecast_dates"](spark, SF_SMALL))
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("Arguments: hashpartitioning(artist_id#") <= 2   # per (artist, day), then per artist


def test_plain_queries_start_no_job_while_built(spark):
    tracker = spark.sparkContext.statusTracker()
    for name in ("rate_table", "join_three_keys", "residuals", "dim_filter_one", "daily_activity"):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        E.queries()[name](spark, SF_SMALL)
        jobs = tracker.getJobIdsForGroup(f"build-{name}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs) <= 2, name      # schema reads, one per table


def test_dimension_filter_is_a_semi_join(spark):
    assert "LeftSemi" in explain_text(E.queries()["dim_filter_one"](spark, SF_SMALL))


def test_filters_and_columns_reach_the_scan(spark):
    plan = explain_text(E.queries()["project_filter"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,21.0)]" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in plan


def test_key_list_pushed_into_scan(spark):
    plan = explain_text(E.queries()["dim_filter_keys"](spark, SF_SMALL))
    assert "PushedFilters: [In(l_partkey" in plan


def test_condition_without_equality_raises(spark):
    import pytest
    from corvid.operators.joins import enrich_where
    a, b = spark.range(5), spark.range(5).withColumnRenamed("id", "k")
    with pytest.raises(ValueError):
        enrich_where(a, b, a["id"] < b["k"])
    assert enrich_where(a, b, (a["id"] == b["k"]) & (b["k"] > 1)).count() == 3


def test_rate_table_has_no_cartesian_join(spark):
    plan = explain_text(E.queries()["rate_table"](spark, SF_SMALL))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_python_udfs_in_registered_plans(spark):
    for name in ("daily_activity", "token_chain_titles", "token_chain_messages", "json_rows", "uri_encode"):
        plan = explain_text(E.queries()[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name
