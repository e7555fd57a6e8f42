"""Traffic over time: by hour of day and by calendar day (UTC wall clock).

Both always derive ``date`` and ``hour`` from the event timestamp, also when
the input carries a ``date`` partition column (the landing date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ERROR_FROM, error_flag_count, percent, with_time_columns
from ..functions.ranking import sort_rows


def hourly_traffic(logs: DataFrame, error_from: int = ERROR_FROM) -> DataFrame:
    """``hour, requests, avg_response_time, errors`` over all days, by hour."""
    result = (
        with_time_columns(logs)
        .groupBy("hour")
        .agg(
            F.count("*").alias("requests"),
            F.round(F.avg("response_time"), 2).alias("avg_response_time"),
            error_flag_count("status_code", error_from).alias("errors"),
        )
    )
    return sort_rows(result, asc=["hour"])


def daily_traffic(logs: DataFrame, error_from: int = ERROR_FROM) -> DataFrame:
    """``date, requests, avg_response_time, error_rate``; the rate is inside the day."""
    result = (
        with_time_columns(logs)
        .groupBy("date")
        .agg(
            F.count("*").alias("requests"),
            F.round(F.avg("response_time"), 2).alias("avg_response_time"),
            error_flag_count("status_code", error_from).alias("_errors"),
        )
        .select("date", "requests", "avg_response_time", percent("_errors", "requests").alias("error_rate"))
    )
    return sort_rows(result, asc=["date"])
