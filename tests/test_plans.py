"""Plan checks: filters reach the Parquet scan, only needed columns are read, the fact
plan has no window and partial aggregation sits before each shuffle."""

import pytest

from lakestrata import catalog as c

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def fact_plan(spark):
    return _plan(c.fact_stalled(spark, SF))


def test_fact_scan_pushdown_and_pruning(fact_plan):
    scan = [line for line in fact_plan.splitlines() if "lineitem.parquet" in line][0]
    assert "EqualTo(l_linestatus,F)" in scan
    assert "l_quantity" not in scan and "l_extendedprice" not in scan  # pruned columns


def test_fact_aggregates_partially_and_has_no_window(fact_plan):
    assert "Window" not in fact_plan
    assert "partial_count(1)" in fact_plan and "partial_max_by" in fact_plan


def test_dims_and_checked_broadcast(spark):
    plan = _plan(c.q_star_left_join(spark, SF))
    assert "BroadcastHashJoin" in plan  # tiny dimensions: planner broadcasts by size


def test_quality_reports_are_single_aggregates(spark):
    plan = _plan(c.q_null_profile(spark, SF))
    assert plan.count("Exchange") == 1  # one aggregate for all columns
    plan = _plan(c.q_integrity_check(spark, SF))
    assert "partial_count" in plan
