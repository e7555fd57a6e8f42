"""Counts by one key: levels, endpoints, status codes, servers, client IPs.

Each is a hash aggregate with a map-side partial step, so a key holding a
third of all rows still ships one partial row per task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ERROR_FROM, error_flag_count, percent, scalar_total
from ..functions.ranking import sort_rows, top_k


def level_distribution(logs: DataFrame) -> DataFrame:
    """``level, count, percentage`` of all logs, most frequent first."""
    counts = logs.groupBy("level").agg(F.count("*").alias("count"))
    total = scalar_total(counts, "count")
    result = counts.select("level", "count", percent("count", total).alias("percentage"))
    return sort_rows(result, desc=["count"], asc=["level"])


def top_endpoints(logs: DataFrame, k: int = 10) -> DataFrame:
    """``endpoint, requests`` for the ``k`` busiest endpoints (NULL is a group)."""
    counts = logs.groupBy("endpoint").agg(F.count("*").alias("requests"))
    return top_k(counts, k, desc=["requests"], asc=["endpoint"])


def error_analysis(logs: DataFrame, error_from: int = ERROR_FROM) -> DataFrame:
    """``status_code, count, error_rate`` for error codes.

    ``error_rate`` is the share of **all** logs (not of errors). All codes are
    grouped and the total is taken from the groups, so the logs are scanned once.
    Errors are told apart by a counted column: a filter on the code itself would
    be pushed below the grouping, and the total would need a scan of its own.
    """
    groups = logs.groupBy("status_code").agg(
        F.count("*").alias("count"), error_flag_count("status_code", error_from).alias("errors")
    )
    # both sides use both counts, so that they read the same shuffle
    total = scalar_total(groups.filter("errors >= 0"), "count")
    errors = groups.filter("errors > 0")
    result = errors.select("status_code", "count", percent("count", total).alias("error_rate"))
    return sort_rows(result, desc=["count"], asc=["status_code"])


def server_performance(logs: DataFrame) -> DataFrame:
    """``server, total_requests, avg_response_ms, max_response_ms``, slowest first."""
    result = logs.groupBy("server").agg(
        F.count("*").alias("total_requests"),
        F.round(F.avg("response_time"), 2).alias("avg_response_ms"),
        F.max("response_time").alias("max_response_ms"),
    )
    return sort_rows(result, desc=["avg_response_ms"], asc=["server"])


def ip_frequency(logs: DataFrame, k: int = 5) -> DataFrame:
    """``ip_address, requests`` for the ``k`` most frequent client addresses."""
    counts = logs.groupBy("ip_address").agg(F.count("*").alias("requests"))
    return top_k(counts, k, desc=["requests"], asc=["ip_address"])
