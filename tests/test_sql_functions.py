"""Table functions with parameters against the analyses."""

from __future__ import annotations

import pytest

from loglens import operators as ops
from loglens.plans.sql_functions import MAX_K, register_functions
from loglens.plans.views import register_views


@pytest.fixture(scope="module")
def functions(spark, logs):
    register_views(spark, logs, prefix="fn_")
    return register_functions(spark, prefix="fn_")


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_reports_with_any_k_and_support(spark, logs, functions):
    assert len(functions) == 8
    assert rows(spark.sql("SELECT * FROM fn_top_endpoints()")) == rows(ops.top_endpoints(logs))
    assert rows(spark.sql("SELECT * FROM fn_top_endpoints(k => 3)")) == rows(ops.top_endpoints(logs, 3))
    assert rows(spark.sql("SELECT * FROM fn_top_addresses(9)")) == rows(ops.ip_frequency(logs, 9))
    for support, k in ((0, 4), (2, 50)):
        want = rows(ops.endpoint_method_pairs(logs, support, k).drop("percentage"))
        assert rows(spark.sql(f"SELECT * FROM fn_frequent_pairs({support}, {k})")) == want
        want = rows(ops.error_patterns(logs, support, k, error_from=500))
        assert rows(spark.sql(f"SELECT * FROM fn_recurring_errors(k => {k}, min_support => {support}, error_from => 500)")) == want
    assert rows(spark.sql("SELECT user_id, requests FROM fn_busiest_users(6)")) == rows(ops.user_activity(logs, 6).select("user_id", "requests"))
    want = rows(ops.session_patterns(logs, 4).drop("unique_pages"))
    assert rows(spark.sql("SELECT * FROM fn_busiest_sessions(4)")) == want
    assert rows(spark.sql("SELECT * FROM fn_slow_servers()")) == rows(ops.server_performance(logs))


def test_parameters_filter_before_grouping(spark, functions):
    got = spark.sql("SELECT * FROM fn_traffic_between(TIMESTAMP_NTZ '2024-01-03 00:00:00', TIMESTAMP_NTZ '2024-01-04 00:00:00')")
    assert {str(r["date"]) for r in got.collect()} == {"2024-01-03"}
    joined = spark.sql("SELECT e.endpoint, count(*) AS n FROM fn_top_endpoints(2) e JOIN fn_logs l ON l.endpoint <=> e.endpoint GROUP BY 1")
    assert rows(joined) == rows(spark.sql("SELECT * FROM fn_top_endpoints(2)"))


def test_a_report_is_a_top_k_per_task(spark, functions):
    plan = spark.sql("SELECT * FROM fn_top_endpoints(3)")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    with pytest.raises(Exception, match="over"):
        spark.sql(f"SELECT * FROM fn_top_endpoints({MAX_K + 1})").collect()
