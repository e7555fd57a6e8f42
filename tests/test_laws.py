"""Invariants between analyses on the sf0.001 log table."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from loglens import operators as ops
from loglens.sources.log_table import log_table
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def table(spark):
    return log_table(spark, SF_SMALL)


def one(df, col):
    return df.collect()[0][col]


def test_counts_by_key_sum_to_total(table):
    total = one(ops.simple_count(table), "count")
    assert total > 0
    for df, col in [
        (ops.level_counts(table), "count"),
        (ops.server_key_counts(table), "count"),
        (ops.hourly_traffic(table), "requests"),
        (ops.daily_traffic(table), "requests"),
        (ops.hour_counts(table), "requests"),
    ]:
        assert df.agg(F.sum(col)).collect()[0][0] == total


def test_percentages_sum_to_100(table):
    pct = ops.level_distribution(table).agg(F.sum("percentage")).collect()[0][0]
    assert abs(pct - 100.0) <= 0.01 * 4


def test_error_views_agree(table):
    errors = one(ops.error_count(table), "count")
    assert ops.error_analysis(table).agg(F.sum("count")).collect()[0][0] == errors
    assert ops.hourly_traffic(table).agg(F.sum("errors")).collect()[0][0] == errors
    assert one(ops.kpi_summary(table), "error_count") == errors


def test_fallback_equals_plain_query_when_groups_pass(table):
    plain = ops.endpoint_method_pairs(table).collect()
    assert plain
    assert ops.frequent_pairs_with_fallback(table).collect() == plain
    assert ops.error_patterns_with_fallback(table).collect() == ops.error_patterns(table).collect()


def test_kpi_summary_matches_the_single_analyses(table):
    k = ops.kpi_summary(table).collect()[0]
    assert k["total_records"] == one(ops.simple_count(table), "count")
    assert k["unique_endpoints"] == one(ops.unique_endpoints(table), "count")
    top = ops.top_endpoints(table, k=1).collect()[0]
    assert (k["top_endpoint"], k["top_endpoint_requests"]) == (top["endpoint"], top["requests"])
    slow = ops.server_performance(table).first()
    assert (k["slowest_server"], k["slowest_server_avg_ms"]) == (slow["server"], slow["avg_response_ms"])


def test_sorted_results_are_in_order(table):
    hours = [r["hour"] for r in ops.hourly_traffic(table).collect()]
    assert hours == sorted(hours)
    counts = [r["count"] for r in ops.level_distribution(table).collect()]
    assert counts == sorted(counts, reverse=True)


def test_top_k_has_one_plan_for_every_k(table):
    def shape(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return re.sub(r"#\d+L?|\b1000[01]\b", "", plan)

    for analysis in (ops.user_activity, ops.session_patterns):
        assert shape(analysis(table, k=10_000)) == shape(analysis(table, k=10_001))
        assert analysis(table, k=10_001).limit(20).collect() == analysis(table, k=20).collect()


def test_few_winners_are_broadcast_without_a_hint(table):
    plan = ops.session_patterns(table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "TakeOrderedAndProject" in plan
