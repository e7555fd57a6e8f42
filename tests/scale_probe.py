"""Throughput of the analyses on a larger log table (not part of pytest).

python -m tests.scale_probe [copies]   (default 50 copies of sf0.1 -> 5M rows)

The log table is built from ``copies`` copies of the sf0.1 ``events`` table,
each with shifted event and user ids (so sessions and users multiply too),
and every analysis is timed (best of two, full result through ``noop``).
"""

from __future__ import annotations

import functools
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from loglens import operators as ops
from loglens.plans.one_scan import analyze_in_one_scan, analyze_one_by_one
from loglens.sources.fixture import logs_from_events
from loglens.sources.log_table import materialize

ANALYSES = [
    "simple_count", "level_distribution", "error_analysis", "server_performance", "hourly_traffic",
    "daily_traffic", "user_activity", "session_patterns", "ip_frequency", "endpoint_method_pairs",
    "error_patterns_with_fallback", "pattern_statistics", "server_activity", "kpi_summary", "distinct_endpoints",
]


def main(argv: list[str]) -> int:
    copies = int(argv[0]) if argv else 50
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loglens-scale-"))
    events = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    shifted = [
        events.withColumn("event_id", F.col("event_id") + i * 1_000_000).withColumn(
            "user_id", F.col("user_id") + (i % 5) * 10_000
        )
        for i in range(copies)
    ]
    table = materialize(spark, logs_from_events(functools.reduce(lambda a, b: a.unionByName(b), shifted).repartition(16)), "scale")
    rows = table.count()
    print(f"| analysis | best s | rows/s |  ({rows:,} rows)")
    for name in ANALYSES:
        best = float("inf")
        for _ in range(2):
            t0 = time.perf_counter()
            getattr(ops, name)(table).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        print(f"| `{name}` | {best:.3f} | {rows / best:,.0f} |", flush=True)
    few = F.when(F.col("endpoint").isNotNull(), F.concat(F.lit("/page/"), F.col("event_id") % 23))
    for label, logs in (("many endpoints", table), ("23 endpoints", table.withColumn("endpoint", few))):
        for how, results in (
            ("one scan", lambda logs=logs: analyze_in_one_scan(spark, logs)),
            ("one by one", lambda logs=logs: analyze_one_by_one(logs)),
        ):
            t0 = time.perf_counter()
            for df in results().values():
                df.write.format("noop").mode("overwrite").save()
            print(f"| report, {label}, {how} | {time.perf_counter() - t0:.2f} | |", flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
