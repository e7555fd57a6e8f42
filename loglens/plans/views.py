"""SQL access: the log views and every analysis as a named temp view.

``register_views`` gives SQL users the two views the analyses are defined
over: ``logs`` (the typed records) and ``logs_time`` (the same with ``date``,
``hour`` and ``day_of_week``). ``register_analyses`` adds one view per named
analysis; all stay lazy until queried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .. import operators as ops
from ..functions.columns import with_time_columns

ANALYSIS_VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "level_distribution": ops.level_distribution,
    "top_endpoints": ops.top_endpoints,
    "error_analysis": ops.error_analysis,
    "server_performance": ops.server_performance,
    "hourly_traffic": ops.hourly_traffic,
    "daily_traffic": ops.daily_traffic,
    "user_activity": ops.user_activity,
    "session_patterns": ops.session_patterns,
    "ip_frequency": ops.ip_frequency,
    "null_counts": ops.null_counts,
    "endpoint_method_pairs": ops.frequent_pairs_with_fallback,
    "error_patterns": ops.error_patterns_with_fallback,
    "pattern_statistics": ops.pattern_statistics,
    "server_activity": ops.server_activity,
    "kpi_summary": ops.kpi_summary,
}


def register_views(spark: SparkSession, logs: DataFrame, prefix: str = "") -> DataFrame:
    """Register ``logs`` and ``logs_time``; returns the time-enhanced frame."""
    logs.createOrReplaceTempView(f"{prefix}logs")
    timed = with_time_columns(logs)
    timed.createOrReplaceTempView(f"{prefix}logs_time")
    return timed


def register_analyses(spark: SparkSession, logs: DataFrame, prefix: str = "") -> dict[str, DataFrame]:
    """Register each named analysis of ``logs`` as a temp view; returns them by name."""
    results = {name: fn(logs) for name, fn in ANALYSIS_VIEWS.items()}
    for name, frame in results.items():
        frame.createOrReplaceTempView(f"{prefix}{name}")
    return results
