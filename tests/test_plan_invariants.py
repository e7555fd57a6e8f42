"""Scale invariants of every registered query, read from its physical plan
(planned, not run, apart from what a query stores on its way)."""

from __future__ import annotations

import pytest

from loglens.plans.catalog import ANALYSES, SOURCES_AND_SINKS
from loglens.plans.one_scan import base_groups, derive, report_cube
from loglens.plans.sql_functions import MAX_K
from loglens.sources.log_table import log_table, materialize
from tests.conftest import SF_SMALL

# queries whose result needs every column of the log table
ALL_COLUMNS = {"time_columns", "sample_rows", "profile_input"}
# the only plans that may broadcast: the k winners of a top-k, a sketch's candidates (fewer than a third
# of its counters), and one row per zone or day
BOUNDED_BROADCAST = {
    "user_activity", "session_patterns", "file_inventory", "one_scan_report", "daily_report", "daily_range", "bucketed_users",
    "bucketed_sessions", "heavy_endpoints", "heavy_addresses", "heavy_users", "heavy_sessions", "manifest_usage", "packed_table",
}
# windows over at most MAX_K rows, kept by a top-k before
BOUNDED_WINDOW = {"sql_functions"}
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "BatchEvalPython", "ArrowEvalPython", "MapInArrow")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(ANALYSES))
def test_plan_has_no_unbounded_operator(spark, key):
    plan = plan_of(ANALYSES[key](spark, SF_SMALL))
    for banned in BANNED:
        assert banned not in plan, f"{key}: {banned}"
    if "BroadcastExchange" in plan:
        assert key in BOUNDED_BROADCAST, key
    if key not in ALL_COLUMNS:
        assert "ReadSchema: struct<event_id:bigint,timestamp" not in plan, f"{key} reads every column"


@pytest.mark.parametrize("key", sorted(SOURCES_AND_SINKS))
def test_sources_and_sinks_have_no_unbounded_operator(spark, key):
    plan = plan_of(SOURCES_AND_SINKS[key](spark, SF_SMALL))
    for banned in BANNED:
        assert banned not in plan or banned == "Window" and key in BOUNDED_WINDOW, f"{key}: {banned}"
    assert key not in BOUNDED_WINDOW or plan.count("Window [") == plan.count(f"TakeOrderedAndProject(limit={MAX_K}")
    if "BroadcastExchange" in plan:
        assert key in BOUNDED_BROADCAST, key


def test_results_from_the_cube_have_no_unbounded_operator(spark):
    base = base_groups(log_table(spark, SF_SMALL))
    assert plan_of(base).count("Expand") == 1
    cube = materialize(spark, report_cube(materialize(spark, base, "base")), "cube")
    for name, df in derive(cube).items():
        plan = plan_of(df)
        for banned in BANNED:
            assert banned not in plan, f"{name}: {banned}"
        assert "BroadcastExchange" not in plan, name
