"""Frequent patterns: endpoint–method pairs, error co-occurrence, statistics.

Minimum support with fallback ("show the frequent groups; if none passes the
threshold, show the top groups without it") is one plan, not a count on the
driver followed by a second query: the groups pass if
``frequency > min_support OR (SELECT MAX(frequency) FROM groups) <= min_support``.
The scalar subquery is over the same grouped frame and reuses its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ERROR_FROM, is_error, percent, scalar_max, scalar_total
from ..functions.ranking import top_k


def _not_null(*names: str) -> Column:
    cond = F.lit(True)
    for name in names:
        cond = cond & F.col(name).isNotNull()
    return cond


def supported(grouped: DataFrame, min_support: int, measure: str = "frequency", fallback: bool = False) -> DataFrame:
    """Groups with ``measure > min_support``; with ``fallback``, all groups when none passes."""
    passes = F.col(measure) > min_support
    if fallback:
        nobody_passes = F.coalesce(scalar_max(grouped, measure), F.lit(0)) <= min_support
        passes = passes | nobody_passes
    return grouped.filter(passes)


def endpoint_method_pairs(logs: DataFrame, min_support: int = 5, k: int = 10, fallback: bool = False) -> DataFrame:
    """``endpoint, method, frequency, percentage`` of frequent pairs, top ``k``.

    ``percentage`` is the share of all logs, including rows whose endpoint or
    method is NULL: all pairs are grouped, the total is taken from the groups
    (one scan), and only then are pairs with a NULL, whose frequency is 0, left out.
    """
    every = logs.groupBy("endpoint", "method").agg(
        F.count("*").alias("n"), F.count_if(_not_null("endpoint", "method")).alias("frequency")
    )
    # all sides use both counts, so that they read the same shuffle
    total = scalar_total(every.filter("n > 0 AND frequency >= 0"), "n")
    groups = supported(every.filter("n > 0 AND frequency > 0"), min_support, fallback=fallback)
    result = groups.select("endpoint", "method", "frequency", percent("frequency", total).alias("percentage"))
    return top_k(result, k, desc=["frequency"], asc=["endpoint", "method"])


def frequent_pairs_with_fallback(logs: DataFrame, min_support: int = 5, k: int = 10) -> DataFrame:
    """:func:`endpoint_method_pairs`, or the top pairs without threshold if none passes."""
    return endpoint_method_pairs(logs, min_support=min_support, k=k, fallback=True)


ERROR_PATTERN_KEYS: Sequence[str] = ("server", "endpoint", "status_code")


def error_patterns(
    logs: DataFrame, min_support: int = 2, k: int = 8, fallback: bool = False, error_from: int = ERROR_FROM
) -> DataFrame:
    """``server, endpoint, status_code, frequency`` of recurring errors, top ``k``."""
    groups = (
        logs.filter(is_error("status_code", error_from) & _not_null("server", "endpoint"))
        .groupBy(*ERROR_PATTERN_KEYS)
        .agg(F.count("*").alias("frequency"))
    )
    return top_k(supported(groups, min_support, fallback=fallback), k, desc=["frequency"], asc=ERROR_PATTERN_KEYS)


def error_patterns_with_fallback(logs: DataFrame, min_support: int = 2, k: int = 8) -> DataFrame:
    """:func:`error_patterns`, or the top error groups without threshold if none passes."""
    return error_patterns(logs, min_support=min_support, k=k, fallback=True)


def pattern_statistics(logs: DataFrame) -> DataFrame:
    """``unique_endpoints, unique_methods, unique_combinations, unique_servers``.

    Over rows whose endpoint and method are both set. A combination is the
    pair itself (two-column distinct), so no separator can merge two pairs. The
    rows are reduced to their different (endpoint, method, server) first, so the
    distinct counts multiply groups, not rows.
    """
    groups = logs.filter(_not_null("endpoint", "method")).groupBy("endpoint", "method", "server")
    # the count keeps Spark from dropping this step as redundant below distinct counts
    return groups.agg(F.count("*").alias("n")).filter("n > 0").agg(
        F.count_distinct("endpoint").alias("unique_endpoints"),
        F.count_distinct("method").alias("unique_methods"),
        F.count_distinct("endpoint", "method").alias("unique_combinations"),
        F.count_distinct("server").alias("unique_servers"),
    )


def server_activity(logs: DataFrame, k: int = 5) -> DataFrame:
    """``server, requests, unique_endpoints, unique_methods`` for the ``k`` busiest servers.

    Counted per (server, endpoint, method) first, so the distinct counts
    multiply groups, not rows.
    """
    groups = logs.filter(F.col("server").isNotNull()).groupBy("server", "endpoint", "method")
    per_server = (
        groups.agg(F.count("*").alias("n"))
        .groupBy("server")
        .agg(
            F.sum("n").alias("requests"),
            F.count_distinct("endpoint").alias("unique_endpoints"),
            F.count_distinct("method").alias("unique_methods"),
        )
    )
    return top_k(per_server, k, desc=["requests"], asc=["server"])
