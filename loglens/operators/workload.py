"""The benchmark workload and the row-level (RDD-style) operations, as DataFrames.

The row operations of the original workload (count, filter, map + distinct,
map + reduce by key, filter + map) all have DataFrame forms here; none ships
rows to Python workers or to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import sort_rows, top_k


def simple_count(logs: DataFrame) -> DataFrame:
    """One row, ``count``: all log entries."""
    return logs.agg(F.count("*").alias("count"))


def level_counts(logs: DataFrame) -> DataFrame:
    """``level, count`` (no order, no share)."""
    return logs.groupBy("level").agg(F.count("*").alias("count"))


def server_requests_avg(logs: DataFrame) -> DataFrame:
    """``server, requests, avg_time`` (unrounded mean), busiest first."""
    result = logs.groupBy("server").agg(
        F.count("*").alias("requests"),
        F.avg("response_time").alias("avg_time"),
    )
    return sort_rows(result, desc=["requests"], asc=["server"])


def hour_counts(logs: DataFrame) -> DataFrame:
    """``hour, requests`` by hour of the (UTC) timestamp."""
    result = logs.groupBy(F.hour("timestamp").alias("hour")).agg(F.count("*").alias("requests"))
    return sort_rows(result, asc=["hour"])


def endpoint_method_top(logs: DataFrame, k: int = 20) -> DataFrame:
    """``endpoint, method, requests`` for the ``k`` most frequent pairs (NULLs are groups)."""
    counts = logs.groupBy("endpoint", "method").agg(F.count("*").alias("requests"))
    return top_k(counts, k, desc=["requests"], asc=["endpoint", "method"])


def distinct_endpoints(logs: DataFrame) -> DataFrame:
    """One row, ``count``: distinct endpoint values with NULL counted as a value."""
    return logs.select("endpoint").distinct().agg(F.count("*").alias("count"))


def server_key_counts(logs: DataFrame) -> DataFrame:
    """``server, count``: requests per server key, NULL included (one row per key)."""
    return logs.groupBy("server").agg(F.count("*").alias("count"))


def error_server_times(logs: DataFrame, level: str = "ERROR") -> DataFrame:
    """``server, response_time`` of every entry at ``level`` (a narrow filter + projection)."""
    return logs.filter(F.col("level") == level).select("server", "response_time")
