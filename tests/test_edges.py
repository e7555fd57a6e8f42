"""Edge semantics on hand-made rows: ties, NULL keys, empty input, fallback, time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from loglens import operators as ops
from loglens.functions import percent
from tests.rows import make_logs


def rows_of(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_top_k_ties_broken_by_key(spark):
    rows = [{"endpoint": e} for e in ["/c", "/b", "/a"] for _ in range(2)]
    out = ops.top_endpoints(make_logs(spark, rows), k=2)
    assert rows_of(out, "endpoint", "requests") == [("/a", 2), ("/b", 2)]


def test_null_endpoint_is_a_group_and_sorts_first_on_ties(spark):
    rows = [{"endpoint": None}, {"endpoint": None}, {"endpoint": "/a"}, {"endpoint": "/a"}, {"endpoint": "/b"}]
    out = ops.top_endpoints(make_logs(spark, rows), k=2)
    assert rows_of(out, "endpoint", "requests") == [(None, 2), ("/a", 2)]


def test_null_guards_per_analysis(spark):
    logs = make_logs(
        spark,
        [
            {"user_id": "u1", "session_id": "s1", "endpoint": "/a", "response_time": 10, "server": "w1"},
            {"user_id": None, "session_id": "s2", "endpoint": "/a", "response_time": 20, "server": None},
            {"user_id": "u1", "session_id": None, "endpoint": "/b", "response_time": 30, "server": "w1"},
        ],
    )
    users = ops.user_activity(logs)
    assert rows_of(users, "user_id", "requests", "sessions", "unique_pages") == [("u1", 2, 1, 2)]
    sessions = {r["session_id"]: r for r in ops.session_patterns(logs).collect()}
    assert set(sessions) == {"s1", "s2"}
    assert sessions["s2"]["user_id"] is None
    servers = {r["server"]: r["total_requests"] for r in ops.server_performance(logs).collect()}
    assert servers == {"w1": 2, None: 1}
    assert rows_of(ops.server_activity(logs), "server", "requests") == [("w1", 2)]


def test_null_status_counts_in_total_never_as_error(spark):
    logs = make_logs(spark, [{"status_code": 500}, {"status_code": None}, {"status_code": 200}, {"status_code": 200}])
    assert rows_of(ops.error_analysis(logs), "status_code", "count", "error_rate") == [(500, 1, 25.0)]
    assert rows_of(ops.error_count(logs), "count") == [(1,)]
    assert rows_of(ops.hourly_traffic(logs), "hour", "requests", "errors") == [(10, 4, 1)]
    assert rows_of(ops.daily_traffic(logs), "requests", "error_rate") == [(4, 25.0)]


def test_empty_input(spark):
    logs = make_logs(spark, [])
    for fn in (ops.level_distribution, ops.top_endpoints, ops.error_analysis, ops.hourly_traffic, ops.user_activity):
        assert fn(logs).count() == 0
    assert rows_of(ops.simple_count(logs), "count") == [(0,)]
    assert rows_of(ops.null_counts(logs), "null_endpoints", "null_methods", "null_servers") == [(0, 0, 0)]
    kpi = ops.kpi_summary(logs).collect()
    assert len(kpi) == 1
    k = kpi[0]
    assert (k["total_records"], k["error_count"], k["error_percentage"], k["top_endpoint"]) == (0, 0, None, None)


def test_support_fallback_when_no_group_passes(spark):
    rows = [{"endpoint": f"/e{i}", "method": "GET"} for i in range(4)]
    logs = make_logs(spark, rows)
    assert ops.endpoint_method_pairs(logs, min_support=5).count() == 0
    fallback = ops.frequent_pairs_with_fallback(logs, min_support=5)
    assert rows_of(fallback, "endpoint", "frequency") == [(f"/e{i}", 1) for i in range(4)]


def test_support_pass_through_when_some_group_passes(spark):
    rows = [{"endpoint": "/hot", "method": "GET"}] * 6 + [{"endpoint": "/cold", "method": "GET"}]
    logs = make_logs(spark, rows)
    expected = [("/hot", "GET", 6, 85.71)]
    assert rows_of(ops.frequent_pairs_with_fallback(logs, min_support=5), "endpoint", "method", "frequency", "percentage") == expected
    assert rows_of(ops.endpoint_method_pairs(logs, min_support=5), "endpoint", "method", "frequency", "percentage") == expected


def test_error_pattern_fallback(spark):
    rows = [{"server": "w1", "endpoint": "/a", "status_code": 500}, {"server": "w1", "endpoint": "/b", "status_code": 404}]
    logs = make_logs(spark, rows)
    assert ops.error_patterns(logs).count() == 0
    assert ops.error_patterns_with_fallback(logs).count() == 2


def test_percentage_counts_rows_with_null_keys(spark):
    rows = [{"endpoint": "/a", "method": "GET"}] * 6 + [{"endpoint": None, "method": "GET"}] * 6
    out = ops.endpoint_method_pairs(make_logs(spark, rows))
    assert rows_of(out, "endpoint", "percentage") == [("/a", 50.0)]


def test_session_bounds_with_and_without_fraction(spark):
    rows = [
        {"session_id": "s", "timestamp": "2024-01-01T00:00:00.500000Z"},
        {"session_id": "s", "timestamp": "2024-01-01T00:00:00Z"},
        {"session_id": "s", "timestamp": "2024-01-01T00:00:00.250Z"},
    ]
    r = ops.session_patterns(make_logs(spark, rows)).collect()[0]
    assert r["session_start"] == dt.datetime(2024, 1, 1, 0, 0, 0)
    assert r["session_end"] == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)


def test_date_and_hour_stay_utc_in_another_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        logs = make_logs(spark, [{"timestamp": "2024-01-01T02:30:00Z"}])
        r = ops.hourly_traffic(logs).collect()[0]
        d = ops.daily_traffic(logs).collect()[0]
        assert r["hour"] == 2
        assert d["date"] == dt.date(2024, 1, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_separator_collision_counts_two_pairs(spark):
    rows = [{"endpoint": "a-b", "method": "c"}, {"endpoint": "a", "method": "b-c"}]
    r = ops.pattern_statistics(make_logs(spark, rows)).collect()[0]
    assert r["unique_combinations"] == 2


def test_distinct_endpoints_counts_null_unique_endpoints_does_not(spark):
    logs = make_logs(spark, [{"endpoint": "/a"}, {"endpoint": None}, {"endpoint": "/a"}])
    assert rows_of(ops.distinct_endpoints(logs), "count") == [(2,)]
    assert rows_of(ops.unique_endpoints(logs), "count") == [(1,)]


def test_percent_rounds_half_up_exactly(spark):
    df = spark.createDataFrame([(201, 20000), (1, 16), (1, 8), (2, 3), (1, 0)], "c long, t long")
    out = df.select(percent("c", "t").alias("p2"), percent("c", "t", 1).alias("p1")).collect()
    assert [(r["p2"], r["p1"]) for r in out] == [(1.01, 1.0), (6.25, 6.3), (12.5, 12.5), (66.67, 66.7), (None, None)]


def test_kpi_summary_picks_winners_with_tie_breaks(spark):
    rows = (
        [{"endpoint": "/b", "server": "s2", "response_time": 100, "status_code": 500}] * 2
        + [{"endpoint": "/a", "server": "s1", "response_time": 100, "status_code": 200}] * 2
        + [{"endpoint": "/c", "server": "s3", "response_time": 50, "status_code": 200}]
    )
    k = ops.kpi_summary(make_logs(spark, rows)).collect()[0]
    assert (k["total_records"], k["error_count"], k["error_percentage"], k["unique_endpoints"]) == (5, 2, 40.0, 3)
    assert (k["top_endpoint"], k["top_endpoint_requests"]) == ("/a", 2)
    assert (k["slowest_server"], k["slowest_server_avg_ms"]) == ("s1", 100.0)


def test_error_server_times_is_a_filter_and_projection(spark):
    logs = make_logs(spark, [{"level": "ERROR", "server": "w", "response_time": 5}, {"level": "INFO", "server": "w"}])
    assert rows_of(ops.error_server_times(logs), "server", "response_time") == [("w", 5)]


def test_profile_input_one_row_per_column(spark):
    logs = make_logs(spark, [{"endpoint": "/a"}, {"endpoint": None}])
    prof = {r["column_name"]: r for r in ops.profile_input(logs).collect()}
    assert len(prof) == 13
    assert prof["endpoint"]["nulls"] == 1 and prof["endpoint"]["records"] == 2
    assert prof["timestamp"]["data_type"] == "timestamp_ntz"
    assert prof["status_code"]["data_type"] == "bigint"


def test_partition_profile_sums_to_total(spark):
    logs = make_logs(spark, [{"endpoint": "/a"}] * 5).repartition(3)
    total = ops.partition_profile(logs).agg(F.sum("records")).collect()[0][0]
    assert total == 5


def test_zone_aware_parsing_shifts_offsets_to_utc(spark):
    from loglens.sources.json_logs import parse_timestamp

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-01-01T05:30:00+05:00",), ("2024-01-01T00:30:00Z",), ("bad",)], "t string")
        got = [r[0] for r in df.select(parse_timestamp("t", zone_aware=True)).collect()]
        assert got == [dt.datetime(2024, 1, 1, 0, 30), dt.datetime(2024, 1, 1, 0, 30), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_traffic_uses_event_date_not_a_landing_date_column(spark):
    logs = make_logs(spark, [{"timestamp": "2024-01-02T23:00:00Z"}]).withColumn("date", F.lit("2024-01-09").cast("date"))
    assert rows_of(ops.daily_traffic(logs), "date") == [(dt.date(2024, 1, 2),)]
