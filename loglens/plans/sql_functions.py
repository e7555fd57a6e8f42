"""Analyses with parameters for SQL users: table functions over the log views.

``SELECT * FROM top_endpoints(k => 20)``. Each function is a plain SQL body over the views of
:func:`.views.register_views`, so Catalyst plans it like any other query. A SQL function can't put a parameter
into LIMIT; a report first keeps its ``MAX_K`` best groups (a top-k per task) and then numbers those.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# The largest k of a report; more raises an error.
MAX_K = 10_000

_ERROR = "status_code >= error_from"
# name -> parameters, columns, grouped query, order
_REPORTS: dict[str, tuple[str, str, str, str]] = {
    "top_endpoints": (
        "k INT DEFAULT 10",
        "endpoint STRING, requests BIGINT",
        "SELECT endpoint, count(*) AS requests FROM {logs} GROUP BY endpoint",
        "requests DESC, endpoint ASC NULLS FIRST",
    ),
    "top_addresses": (
        "k INT DEFAULT 5",
        "ip_address STRING, requests BIGINT",
        "SELECT ip_address, count(*) AS requests FROM {logs} GROUP BY ip_address",
        "requests DESC, ip_address ASC NULLS FIRST",
    ),
    "busiest_users": (
        "k INT DEFAULT 15",
        "user_id STRING, requests BIGINT, avg_response_time DOUBLE",
        "SELECT user_id, count(*) AS requests, round(avg(response_time), 2) AS avg_response_time FROM {logs} "
        "WHERE user_id IS NOT NULL GROUP BY user_id",
        "requests DESC, user_id",
    ),
    "busiest_sessions": (
        "k INT DEFAULT 10",
        "session_id STRING, user_id STRING, page_views BIGINT, session_start TIMESTAMP_NTZ, session_end TIMESTAMP_NTZ",
        "SELECT session_id, user_id, count(*) AS page_views, min(timestamp) AS session_start, max(timestamp) AS session_end "
        "FROM {logs} WHERE session_id IS NOT NULL GROUP BY session_id, user_id",
        "page_views DESC, session_id, user_id ASC NULLS FIRST",
    ),
    "frequent_pairs": (
        "min_support BIGINT DEFAULT 5, k INT DEFAULT 10",
        "endpoint STRING, method STRING, frequency BIGINT",
        "SELECT endpoint, method, count(*) AS frequency FROM {logs} WHERE endpoint IS NOT NULL AND method IS NOT NULL "
        "GROUP BY endpoint, method HAVING count(*) > min_support",
        "frequency DESC, endpoint, method",
    ),
    "recurring_errors": (
        "min_support BIGINT DEFAULT 2, k INT DEFAULT 8, error_from BIGINT DEFAULT 400",
        "server STRING, endpoint STRING, status_code BIGINT, frequency BIGINT",
        f"SELECT server, endpoint, status_code, count(*) AS frequency FROM {{logs}} WHERE {_ERROR} AND server IS NOT NULL "
        "AND endpoint IS NOT NULL GROUP BY server, endpoint, status_code HAVING count(*) > min_support",
        "frequency DESC, server, endpoint, status_code",
    ),
}

# name -> parameters, columns, query without a limit
_TABLES: dict[str, tuple[str, str, str]] = {
    "traffic_between": (
        "start TIMESTAMP_NTZ, stop TIMESTAMP_NTZ, error_from BIGINT DEFAULT 400",
        "date DATE, hour INT, requests BIGINT, errors BIGINT",
        # a parameter may not stand inside an aggregate
        f"SELECT date, hour, count(*) AS requests, count_if(error) AS errors FROM (SELECT date, hour, {_ERROR} AS error "
        "FROM {logs_time} WHERE timestamp >= start AND timestamp < stop) GROUP BY date, hour",
    ),
    "slow_servers": (
        "min_mean DOUBLE DEFAULT 0.0",
        "server STRING, total_requests BIGINT, avg_response_ms DOUBLE, max_response_ms BIGINT",
        "SELECT server, count(*) AS total_requests, round(avg(response_time), 2) AS avg_response_ms, max(response_time) AS max_response_ms "
        "FROM {logs} GROUP BY server HAVING round(avg(response_time), 2) >= min_mean",
    ),
}


def function_statements(prefix: str = "") -> dict[str, str]:
    """``CREATE TEMPORARY FUNCTION`` statements by name, over the views ``<prefix>logs`` and ``<prefix>logs_time``."""
    views = {"logs": f"{prefix}logs", "logs_time": f"{prefix}logs_time"}
    out = {}
    for name, (parameters, columns, query, order) in _REPORTS.items():
        names = ", ".join(c.split()[0] for c in columns.split(", "))
        best = f"SELECT * FROM ({query.format(**views)}) ORDER BY {order} LIMIT {MAX_K}"
        numbered = f"SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM ({best})"
        most = f"if(k <= {MAX_K}, k, raise_error('k is over {MAX_K}'))"
        body = f"SELECT {names} FROM ({numbered}) WHERE place <= {most}"
        out[name] = f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}"
    for name, (parameters, columns, query) in _TABLES.items():
        out[name] = f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS TABLE ({columns}) RETURN {query.format(**views)}"
    return out


def register_functions(spark: SparkSession, prefix: str = "") -> list[str]:
    """Register the table functions over the views registered with the same ``prefix``; returns their names."""
    statements = function_statements(prefix)
    for statement in statements.values():
        spark.sql(statement)
    return [f"{prefix}{name}" for name in statements]
