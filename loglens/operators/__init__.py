"""The named analyses. Each is a lazy ``DataFrame -> DataFrame`` function."""

from .distribution import error_analysis, ip_frequency, level_distribution, server_performance, top_endpoints
from .patterns import (
    endpoint_method_pairs,
    error_patterns,
    error_patterns_with_fallback,
    frequent_pairs_with_fallback,
    pattern_statistics,
    server_activity,
    supported,
)
from .quality import null_counts, partition_profile, profile_input, sample_rows
from .summary import error_count, kpi_summary, unique_endpoints
from .traffic import daily_traffic, hourly_traffic
from .users import session_patterns, user_activity
from .workload import (
    distinct_endpoints,
    endpoint_method_top,
    error_server_times,
    hour_counts,
    level_counts,
    server_key_counts,
    server_requests_avg,
    simple_count,
)

__all__ = [
    "daily_traffic",
    "distinct_endpoints",
    "endpoint_method_pairs",
    "endpoint_method_top",
    "error_analysis",
    "error_count",
    "error_patterns",
    "error_patterns_with_fallback",
    "error_server_times",
    "frequent_pairs_with_fallback",
    "hour_counts",
    "hourly_traffic",
    "ip_frequency",
    "kpi_summary",
    "level_counts",
    "level_distribution",
    "null_counts",
    "partition_profile",
    "pattern_statistics",
    "profile_input",
    "sample_rows",
    "server_activity",
    "server_key_counts",
    "server_performance",
    "server_requests_avg",
    "session_patterns",
    "simple_count",
    "supported",
    "top_endpoints",
    "unique_endpoints",
    "user_activity",
]
