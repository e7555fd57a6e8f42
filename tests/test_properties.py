"""Property test: on random small log sets (many NULLs and ties), every
analysis equals its SQL oracle evaluated by DuckDB over the same rows."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loglens import operators as ops
from loglens.plans.oracle import oracle_queries
from loglens.schema import LOG_FIELDS
from tests.oracle_compare import compare
from tests.rows import make_logs

BASE = dt.datetime(2024, 1, 1)
TIMES = [BASE + dt.timedelta(hours=h, microseconds=us) for h in (0, 1, 23, 25, 47) for us in (0, 500000)]

ANALYSES = {
    "level_distribution": ops.level_distribution,
    "top_endpoints": ops.top_endpoints,
    "error_analysis": ops.error_analysis,
    "server_performance": ops.server_performance,
    "hourly_traffic": ops.hourly_traffic,
    "daily_traffic": ops.daily_traffic,
    "user_activity": ops.user_activity,
    "session_patterns": ops.session_patterns,
    "error_count": ops.error_count,
    "ip_frequency": ops.ip_frequency,
    "unique_endpoints": ops.unique_endpoints,
    "null_counts": ops.null_counts,
    "endpoint_method_pairs": ops.endpoint_method_pairs,
    "support_pass_through": lambda logs: ops.frequent_pairs_with_fallback(logs, min_support=5),
    "error_patterns": ops.error_patterns,
    "error_patterns_fallback": ops.error_patterns_with_fallback,
    "pattern_statistics": ops.pattern_statistics,
    "server_activity": ops.server_activity,
    "kpi_summary": ops.kpi_summary,
    "simple_count": ops.simple_count,
    "level_counts": ops.level_counts,
    "server_requests_avg": ops.server_requests_avg,
    "hour_counts": ops.hour_counts,
    "endpoint_method_top20": ops.endpoint_method_top,
    "distinct_endpoints": ops.distinct_endpoints,
    "server_key_counts": ops.server_key_counts,
    "error_server_times": ops.error_server_times,
}

ORACLE = oracle_queries("SELECT * FROM input_logs")

row = st.fixed_dictionaries(
    {
        "ts": st.sampled_from(TIMES),
        "level": st.sampled_from(["INFO", "WARN", "ERROR", "DEBUG", None]),
        "server": st.sampled_from(["w1", "w2", None]),
        "ip_address": st.sampled_from(["10.0.0.1", "10.0.0.2", None]),
        "method": st.sampled_from(["GET", "POST", None]),
        "endpoint": st.sampled_from(["/a", "/b", "a-b", None]),
        "status_code": st.sampled_from([200, 204, 400, 404, 500, None]),
        "response_time": st.one_of(st.none(), st.integers(0, 3000)),
        "user_id": st.sampled_from(["u1", "u2", "u3", None]),
        "session_id": st.sampled_from(["s1", "s2", "s3", None]),
    }
)

_DUCK_TYPES = {"timestamp": "TIMESTAMP", "status_code": "BIGINT", "response_time": "BIGINT", "bytes_sent": "BIGINT"}


def _duck(rows: list[dict]) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    cols = ", ".join(f'"{f}" {_DUCK_TYPES.get(f, "VARCHAR")}' for f in LOG_FIELDS)
    con.execute(f"CREATE TABLE input_logs ({cols})")
    if rows:
        marks = ", ".join("?" for _ in LOG_FIELDS)
        con.executemany(f"INSERT INTO input_logs VALUES ({marks})", [[r.get(f) for f in LOG_FIELDS] for r in rows])
    return con


@pytest.mark.parametrize("group", [sorted(ANALYSES)[0::2], sorted(ANALYSES)[1::2]], ids=["a", "b"])
@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=40))
def test_analyses_equal_sql_on_random_rows(spark, group, rows):
    records = [{**r, "timestamp": r["ts"]} for r in rows]
    con = _duck(records)
    logs = make_logs(spark, [{**r, "timestamp": r["ts"].isoformat() + "Z"} for r in rows])
    for key in group:
        ok, msg = compare(ANALYSES[key](logs), con, ORACLE[key], exact=True)
        assert ok, f"{key}: {msg}\nrows={rows}"


def test_hot_key_holding_a_third_of_all_rows(spark):
    hot = [
        {"ts": TIMES[i % len(TIMES)], "level": "INFO", "server": "w1", "ip_address": "10.0.0.9", "method": "GET",
         "endpoint": "/hot", "status_code": 500 if i % 3 == 0 else 200, "response_time": i, "user_id": "bot",
         "session_id": "s-bot"}
        for i in range(100)
    ]
    rest = [
        {"ts": TIMES[i % len(TIMES)], "level": ["INFO", "ERROR", None][i % 3], "server": ["w1", "w2", None][i % 3],
         "ip_address": f"10.0.1.{i % 17}", "method": ["GET", "POST", None][i % 3], "endpoint": f"/e{i % 11}",
         "status_code": [200, 404, 503, None][i % 4], "response_time": (i * 37) % 900, "user_id": f"u{i % 23}",
         "session_id": f"s{i % 41}"}
        for i in range(200)
    ]
    rows = hot + rest
    con = _duck([{**r, "timestamp": r["ts"]} for r in rows])
    logs = make_logs(spark, [{**r, "timestamp": r["ts"].isoformat() + "Z"} for r in rows])
    for key in ["user_activity", "session_patterns", "top_endpoints", "ip_frequency", "kpi_summary",
                "error_patterns_fallback", "server_activity", "pattern_statistics"]:
        ok, msg = compare(ANALYSES[key](logs), con, ORACLE[key], exact=True)
        assert ok, f"{key}: {msg}"


text_row = st.fixed_dictionaries(
    {
        "ts": st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2100, 1, 1)),
        "endpoint": st.one_of(st.none(), st.text(max_size=12)),
        "user_agent": st.one_of(st.none(), st.text(max_size=20)),
        "status_code": st.one_of(st.none(), st.integers(-(2**40), 2**40)),
    }
)


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(text_row, min_size=1, max_size=25))
def test_json_landing_round_trips_any_text(spark, rows):
    from loglens.schema import RAW_SCHEMA
    from loglens.session import fresh_path
    from loglens.sinks.landing import land_raw
    from loglens.sources.json_logs import read_json_logs

    logs = make_logs(spark, [{**r, "timestamp": r["ts"].isoformat() + "Z"} for r in rows])
    back = read_json_logs(spark, land_raw(logs, fresh_path(spark, "prop-json")), RAW_SCHEMA)
    assert logs.exceptAll(back).count() == 0 and back.exceptAll(logs).count() == 0


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(text_row, min_size=1, max_size=8))
def test_partitioned_and_csv_sinks_round_trip(spark, rows):
    from pyspark.sql import functions as F

    from loglens.schema import LOG_SCHEMA, RAW_SCHEMA
    from loglens.session import fresh_path
    from loglens.sinks.landing import land_partitioned, save_result_csv
    from loglens.sources.json_logs import read_partitioned_logs
    from loglens.sources.results import read_result_csv

    logs = make_logs(spark, [{**r, "timestamp": r["ts"].isoformat() + "Z"} for r in rows])
    parted = read_partitioned_logs(spark, land_partitioned(logs, fresh_path(spark, "prop-part"), cluster=True), schema=RAW_SCHEMA)
    dated = logs.withColumn("date", F.to_date("timestamp"))
    assert dated.exceptAll(parted).count() == 0 and parted.exceptAll(dated).count() == 0
    path = save_result_csv(logs, fresh_path(spark, "prop-csv"), null_value="\\N")
    back = read_result_csv(spark, path, LOG_SCHEMA, null_value="\\N")
    assert logs.exceptAll(back).count() == 0 and back.exceptAll(logs).count() == 0


@settings(max_examples=10, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    items=st.lists(
        st.tuples(st.datetimes(min_value=dt.datetime(2001, 1, 1), max_value=dt.datetime(2090, 1, 1)), st.integers(-48, 56)),
        min_size=1,
        max_size=30,
    ),
    zone=st.sampled_from(["UTC", "America/New_York", "Asia/Kolkata"]),
)
def test_zone_aware_parsing_matches_python(spark, items, zone):
    from loglens.sources.json_logs import parse_timestamp

    texts = [(wall.replace(tzinfo=dt.timezone(dt.timedelta(minutes=15 * q))).isoformat(),) for wall, q in items]
    want = [wall - dt.timedelta(minutes=15 * q) for wall, q in items]
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = [r[0] for r in spark.createDataFrame(texts, "t string").select(parse_timestamp("t", zone_aware=True)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == want
