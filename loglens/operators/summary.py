"""Scalar findings and the one-row KPI summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ERROR_FROM, error_flag_count, is_error, mean_of, percent


def error_count(logs: DataFrame, error_from: int = ERROR_FROM) -> DataFrame:
    """One row, ``count``: log entries with an error status."""
    return logs.filter(is_error("status_code", error_from)).agg(F.count("*").alias("count"))


def unique_endpoints(logs: DataFrame) -> DataFrame:
    """One row, ``count``: distinct non-NULL endpoints."""
    return logs.agg(F.count_distinct("endpoint").alias("count"))


def kpi_summary(logs: DataFrame, error_from: int = ERROR_FROM) -> DataFrame:
    """One row of key findings, from one scan of the logs.

    ``total_records, error_count, error_percentage`` (1 place),
    ``unique_endpoints``, ``top_endpoint, top_endpoint_requests`` (first row of
    :func:`top_endpoints`) and ``slowest_server, slowest_server_avg_ms`` (first
    row of :func:`server_performance`).

    The rows are grouped by (endpoint, server) in one scan; the three levels (by
    endpoint, by server, all) come from one ``GROUPING SETS`` aggregate over those
    groups, and a final one-row aggregate picks the winners with ``min_by`` under
    the same tie-break order as the top-k analyses.
    """
    groups = logs.groupBy("endpoint", "server").agg(
        F.count("*").alias("n"),
        error_flag_count("status_code", error_from).alias("errors"),
        F.sum("response_time").alias("rt_sum"),
        F.count("response_time").alias("rt_count"),
    )
    sets = groups.groupingSets([["endpoint"], ["server"], []], "endpoint", "server").agg(
        F.grouping_id().alias("gid"),
        F.sum("n").alias("n"),
        F.sum("errors").alias("errors"),
        F.round(mean_of(F.sum("rt_sum"), F.sum("rt_count")), 2).alias("avg_ms"),
    )
    # grouping_id bits: 1 = by endpoint only, 2 = by server only, 3 = all rows
    return kpi_from_groups(sets, endpoint_gid=1, server_gid=2, overall_gid=3)


def kpi_from_groups(
    groups: DataFrame, endpoint_gid: int | str, server_gid: int | str, overall_gid: int | str
) -> DataFrame:
    """The KPI row from per-endpoint, per-server and overall groups.

    ``groups`` has ``gid, endpoint, server, n, errors, avg_ms`` (the rounded
    mean). One global aggregate (partial per task) picks the winners with
    ``min_by`` under the tie-break order of the top-k analyses.
    """
    by_endpoint = F.col("gid") == endpoint_gid
    by_server = F.col("gid") == server_gid
    overall = F.col("gid") == overall_gid
    n, avg_ms = F.col("n"), F.col("avg_ms")
    kpis = groups.agg(
        F.sum(F.when(overall, n)).alias("total_records"),
        F.sum(F.when(overall, F.col("errors"))).alias("error_count"),
        F.count_if(by_endpoint & F.col("endpoint").isNotNull()).alias("unique_endpoints"),
        # most requests first, then endpoint ascending with NULL first
        F.min_by(F.struct(F.col("endpoint"), n), F.when(by_endpoint, F.struct(-n, F.col("endpoint")))).alias("_top"),
        # highest rounded mean first (NULL means last), then server ascending
        F.min_by(
            F.struct(F.col("server"), avg_ms),
            F.when(by_server, F.struct(avg_ms.isNull(), -avg_ms, F.col("server"))),
        ).alias("_slow"),
    )
    return kpis.select(
        F.coalesce("total_records", F.lit(0)).alias("total_records"),
        F.coalesce("error_count", F.lit(0)).alias("error_count"),
        percent("error_count", "total_records", 1).alias("error_percentage"),
        "unique_endpoints",
        F.col("_top.endpoint").alias("top_endpoint"),
        F.col("_top.n").alias("top_endpoint_requests"),
        F.col("_slow.server").alias("slowest_server"),
        F.col("_slow.avg_ms").alias("slowest_server_avg_ms"),
    )
