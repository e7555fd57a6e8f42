"""Physical-plan checks: one scan for shares of a total, top-k without a full
sort, partition and column pruning."""

from __future__ import annotations

from loglens import operators as ops
from loglens.plans.catalog import partition_day
from loglens.sources.log_table import log_table
from tests.conftest import SF_SMALL
from tests.plan_report import final_plan as executed_plan


def test_share_of_total_reuses_the_grouped_shuffle(spark):
    plan = executed_plan(ops.level_distribution(log_table(spark, SF_SMALL)))
    assert "ReusedExchange" in plan
    assert plan.count("FileScan parquet") == 1
    assert "Window" not in plan


def test_top_k_is_take_ordered(spark):
    plan = ops.user_activity(log_table(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_partition_filter_prunes_directories(spark):
    df = partition_day(spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "2024-01-15" in plan
    assert df.select("date").distinct().count() == 1


def test_scan_reads_only_used_columns(spark):
    plan = ops.error_count(log_table(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<status_code:bigint>" in plan
    assert "PushedFilters: [IsNotNull(status_code), GreaterThanOrEqual(status_code,400)]" in plan


def expands_rows(plan: str) -> bool:
    """Whether an ``Expand`` multiplies scanned rows (it stands in a scan's stage, without an aggregate between)."""
    from_expand = plan[plan.index("Expand") :] if "Expand" in plan else ""
    return "Expand" in plan and "Exchange" not in from_expand.split("FileScan")[0]


def test_analyses_scan_once_and_multiply_groups_only(spark):
    table = log_table(spark, SF_SMALL)
    for analysis in (ops.kpi_summary, ops.pattern_statistics, ops.server_activity, ops.error_analysis, ops.endpoint_method_pairs):
        plan = executed_plan(analysis(table))
        assert plan.count("FileScan parquet") == 1, analysis.__name__
        assert not expands_rows(plan), analysis.__name__


def test_fallback_subquery_reuses_the_grouped_shuffle(spark):
    plan = executed_plan(ops.error_patterns_with_fallback(log_table(spark, SF_SMALL)))
    assert "ReusedExchange" in plan
