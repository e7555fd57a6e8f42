"""The mechanisms of storage and state against the plain plans on a larger log table (not part of pytest).

python -m tests.feature_probe [copies]   (default 10 copies of sf0.1 -> 1M rows)

Best of two, full results through ``noop``; every pair gives equal rows in the tests.
"""

from __future__ import annotations

import functools
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loglens import operators as ops
from loglens.operators import heavy_hitters as hh
from loglens.plans.daily_state import DailyState
from loglens.plans.one_scan import analyze_in_one_scan
from loglens.session import fresh_path
from loglens.sources.bucketed import store_bucketed
from loglens.sources.fixture import logs_from_events
from loglens.sources.log_table import read_log_table, store_logs
from loglens.sources.lookup import find_logs, store_lookup_logs


def timed(label: str, run, n: int = 2) -> None:
    best = float("inf")
    for _ in range(n):
        t0 = time.perf_counter()
        run()
        best = min(best, time.perf_counter() - t0)
    print(f"| {label} | {best:.2f} |", flush=True)


def force(*frames) -> None:
    for frame in frames:
        frame.write.format("noop").mode("overwrite").save()


def main(argv: list[str]) -> int:
    copies = int(argv[0]) if argv else 10
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="loglens-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loglens-probe-"))
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    shifted = [
        events.withColumn("event_id", F.col("event_id") + i * 1_000_000).withColumn("user_id", F.col("user_id") + (i % 5) * 10_000)
        for i in range(copies)
    ]
    raw = logs_from_events(functools.reduce(lambda a, b: a.unionByName(b), shifted).repartition(16))
    schema = raw.schema
    loose_path, packed_path = store_logs(spark, raw, cluster=False), store_logs(spark, raw)
    loose, logs = (read_log_table(spark, p, schema=schema) for p in (loose_path, packed_path))
    print(f"| {logs.count():,} rows | best s |\n| --- | --- |")
    for name, table in (("loose", loose), ("packed", logs)):
        print(f"| files, {name} | {len(table.inputFiles())} |")
        timed(f"count, server performance, server activity: {name}", lambda t=table: force(ops.simple_count(t), ops.server_performance(t), ops.server_activity(t)))
    for exact, heavy in (
        (ops.top_endpoints, hh.heavy_top_endpoints), (ops.ip_frequency, hh.heavy_ip_frequency),
        (ops.user_activity, hh.heavy_user_activity), (ops.session_patterns, hh.heavy_session_patterns),
    ):
        timed(f"{exact.__name__}: all keys", lambda f=exact: force(f(logs)))
        timed(f"{exact.__name__}: by sketch", lambda f=heavy: force(f(logs)))
    bucketed = store_bucketed(spark, logs, "probe_bucketed", 8)
    timed("user_activity, session_patterns: log table", lambda: force(ops.user_activity(logs), ops.session_patterns(logs)))
    timed("user_activity, session_patterns: buckets", lambda: force(ops.user_activity(bucketed), ops.session_patterns(bucketed)))
    state = DailyState.open(spark, fresh_path(spark, "probe-state"))
    t0 = time.perf_counter()
    state = state.refresh(logs)
    print(f"| daily state: first build | {time.perf_counter() - t0:.2f} |", flush=True)
    day = read_log_table(spark, packed_path, dates=["2024-01-15"], schema=schema)
    t0 = time.perf_counter()
    state = state.refresh(day, days=["2024-01-15"])
    print(f"| daily state: one day again | {time.perf_counter() - t0:.2f} |", flush=True)
    days = [f"2024-01-{d:02d}" for d in range(10, 21)]
    some = read_log_table(spark, packed_path, dates=days, schema=schema)
    timed("report of 11 days: one scan over rows", lambda: force(*analyze_in_one_scan(spark, some).values()))
    timed("report of 11 days: daily state", lambda: force(*state.results(days).values()))
    both = [ops.unique_endpoints, ops.pattern_statistics]
    timed("distinct counts of 11 days: rows", lambda: force(*(f(some) for f in both)))
    timed("distinct counts of 11 days: bitmaps", lambda: force(state.distinct_counts(days)))
    lookup = store_lookup_logs(spark, logs, row_group_bytes=1 << 20, expected=20_000)
    session = logs.agg(F.max("session_id")).first()[0]
    timed("one session's rows: log table", lambda: force(logs.filter(F.col("session_id") == session)))
    timed("one session's rows: look-up table", lambda: force(find_logs(spark, lookup, schema, session_id=session)))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
