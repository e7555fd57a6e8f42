"""The one-scan report equals the analyses run one by one."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loglens import operators as ops
from loglens.plans.one_scan import DIRECT_EQUIVALENTS, analyze_in_one_scan, base_groups, derive, report_cube
from loglens.sources.log_table import log_table
from tests.conftest import SF_SMALL
from tests.plan_report import final_plan
from tests.rows import make_logs
from tests.test_properties import row

DIRECT = {k: f for k, f in DIRECT_EQUIVALENTS.items() if k not in ("user_activity", "session_patterns")}


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _assert_same(derived: dict, logs) -> None:
    assert set(DIRECT) <= set(derived)
    for name, direct in DIRECT.items():
        want = direct(logs)
        got = derived[name]
        assert got.columns == want.columns, name
        assert _rows(got) == _rows(want), name


def test_one_scan_report_equals_direct_analyses(spark):
    logs = log_table(spark, SF_SMALL)
    results = analyze_in_one_scan(spark, logs)
    _assert_same(results, logs)
    assert _rows(results["user_activity"]) == _rows(ops.user_activity(logs))
    # ordered results keep their order
    assert results["hourly_traffic"].collect() == ops.hourly_traffic(logs).collect()


def test_cube_is_one_scan_with_partial_aggregation(spark):
    plan = final_plan(base_groups(log_table(spark, SF_SMALL)))
    assert plan.count("FileScan parquet") == 1
    assert "Expand" in plan and "partial_count" in plan


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=0, max_size=40))
def test_one_scan_equals_direct_on_random_rows(spark, rows):
    logs = make_logs(spark, [{**r, "timestamp": r["ts"].isoformat() + "Z"} for r in rows])
    _assert_same(derive(report_cube(base_groups(logs))), logs)


def test_one_scan_on_empty_input(spark):
    _assert_same(derive(report_cube(base_groups(make_logs(spark, [])))), make_logs(spark, []))


def test_one_scan_report_matches_the_sql_oracle(spark, duck):
    from loglens.plans.oracle import oracle_queries
    from tests.oracle_compare import compare

    oracle = oracle_queries()
    same_as = {"endpoint_method_pairs": "support_pass_through", "error_patterns": "error_patterns_fallback"}
    for name, df in analyze_in_one_scan(spark, log_table(spark, SF_SMALL)).items():
        ok, msg = compare(df, duck, oracle[same_as.get(name, name)], exact=True)
        assert ok, f"{name}: {msg}"
