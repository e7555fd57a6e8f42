"""Independent SQL (DuckDB dialect) for every registered query.

Each statement recomputes a result from the raw tables with plain SQL, so it
shares no code path with the Spark plans it checks. Oracle-side conventions:

* percentages and rounded means are computed in integers and rounded half up
  (``(20000*c + t) // (2*t)`` hundredths), which is exactly what Spark's
  decimal ``ROUND`` gives, independent of binary-double ties;
* top-k tie-breakers are ``key ASC NULLS FIRST`` as in Spark;
* DuckDB's ``hour()`` is BIGINT and ``dayofweek()`` counts Sunday as 0, so
  both are adjusted to Spark's INT and 1..7.
"""

from __future__ import annotations

from ..sources.fixture import (
    ERROR_CODES,
    LEVEL_OF_EVENT,
    METHODS,
    SUCCESS_CODES,
    USER_AGENTS,
)


def _list(values: list) -> str:
    return "[" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in values) + "]"


def _level_case() -> str:
    whens = " ".join(f"WHEN '{e}' THEN '{lvl}'" for e, lvl in LEVEL_OF_EVENT.items())
    return f"CASE event_type {whens} ELSE 'INFO' END"


LOG_VIEW_SQL = f"""
SELECT event_id, ts AS timestamp,
  {_level_case()} AS level,
  CASE WHEN k % 25 = 7 THEN NULL ELSE CONCAT('server-', CAST(user_id % 101 AS VARCHAR)) END AS server,
  CONCAT('app-', CAST(k % 4 AS VARCHAR)) AS application,
  CONCAT('192.168.', CAST(user_id % 10 + 1 AS VARCHAR), '.', CAST(100 + k AS VARCHAR)) AS ip_address,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE list_extract({_list(METHODS)}, CAST((event_id % 7) % 4 AS INT) + 1) END AS method,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE CONCAT('/', event_type, '/',
       CAST(CASE WHEN event_id % 5 = 0 THEN 100 + event_id // 40 ELSE k % 10 END AS VARCHAR)) END AS endpoint,
  CAST(CASE WHEN event_id % 101 = 0 THEN NULL
            WHEN event_type = 'error' THEN list_extract({_list(ERROR_CODES)}, CAST(event_id % 7 AS INT) + 1)
            ELSE list_extract({_list(SUCCESS_CODES)}, CAST(event_id % 4 AS INT) + 1) END AS BIGINT) AS status_code,
  CAST(floor(value * 10) AS BIGINT) + CASE WHEN event_type = 'error' THEN 100 ELSE 50 END AS response_time,
  CASE WHEN user_id % 20 = 3 THEN NULL ELSE CONCAT('user_', CAST(1000 + user_id AS VARCHAR)) END AS user_id,
  CASE WHEN event_id % 50 = 1 THEN NULL ELSE CONCAT('sess_', CAST(user_id AS VARCHAR), '_', strftime(ts, '%Y%m%d')) END AS session_id,
  500 + ((event_id % 49501) * 37) % 49501 AS bytes_sent,
  list_extract({_list(USER_AGENTS)}, CAST(event_id % 3 AS INT) + 1) AS user_agent
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)
"""


def pct(part: str, whole: str, scale: int = 2) -> str:
    """Half-up ``ROUND(part * 100 / whole, scale)`` in integers, as DOUBLE."""
    unit = 10**scale
    return (
        f"(CAST(((2 * {100 * unit} * ({part}) + ({whole})) // (2 * ({whole}))) AS DOUBLE) / {unit})"
    )


def mean2(x: str) -> str:
    """Half-up ``ROUND(AVG(x), 2)`` in integers, as DOUBLE (non-negative x)."""
    return f"(CAST(((200 * SUM({x}) + COUNT({x})) // (2 * COUNT({x}))) AS DOUBLE) / 100)"


ERR = "status_code >= 400"


def _pairs_with_fallback(min_support: int) -> str:
    """Pairs with support > n, or all pairs when none passes; top 10."""
    return f"""
        , g AS (
          SELECT endpoint, method, COUNT(*) AS frequency
          FROM logs WHERE endpoint IS NOT NULL AND method IS NOT NULL
          GROUP BY endpoint, method)
        SELECT endpoint, method, frequency,
               {pct('frequency', '(SELECT COUNT(*) FROM logs)')} AS percentage
        FROM g
        WHERE frequency > {min_support} OR (SELECT COALESCE(MAX(frequency), 0) FROM g) <= {min_support}
        ORDER BY frequency DESC, endpoint, method LIMIT 10"""

_BODIES: dict[str, str] = {
    "level_distribution": f"""
        SELECT level, COUNT(*) AS count, {pct('COUNT(*)', '(SELECT COUNT(*) FROM logs)')} AS percentage
        FROM logs GROUP BY level ORDER BY count DESC, level ASC NULLS FIRST""",
    "top_endpoints": """
        SELECT endpoint, COUNT(*) AS requests FROM logs GROUP BY endpoint
        ORDER BY requests DESC, endpoint ASC NULLS FIRST LIMIT 10""",
    "error_analysis": f"""
        SELECT status_code, COUNT(*) AS count, {pct('COUNT(*)', '(SELECT COUNT(*) FROM logs)')} AS error_rate
        FROM logs WHERE {ERR} GROUP BY status_code ORDER BY count DESC, status_code""",
    "server_performance": f"""
        SELECT server, COUNT(*) AS total_requests, {mean2('response_time')} AS avg_response_ms,
               MAX(response_time) AS max_response_ms
        FROM logs GROUP BY server ORDER BY avg_response_ms DESC, server ASC NULLS FIRST""",
    "hourly_traffic": f"""
        SELECT CAST(hour(timestamp) AS INTEGER) AS hour, COUNT(*) AS requests,
               {mean2('response_time')} AS avg_response_time,
               COUNT(*) FILTER (WHERE {ERR}) AS errors
        FROM logs GROUP BY 1 ORDER BY 1""",
    "daily_traffic": f"""
        SELECT CAST(timestamp AS DATE) AS date, COUNT(*) AS requests,
               {mean2('response_time')} AS avg_response_time,
               {pct(f'COUNT(*) FILTER (WHERE {ERR})', 'COUNT(*)')} AS error_rate
        FROM logs GROUP BY 1 ORDER BY 1""",
    "user_activity": f"""
        SELECT user_id, COUNT(*) AS requests, COUNT(DISTINCT session_id) AS sessions,
               COUNT(DISTINCT endpoint) AS unique_pages, {mean2('response_time')} AS avg_response_time
        FROM logs WHERE user_id IS NOT NULL GROUP BY user_id
        ORDER BY requests DESC, user_id LIMIT 15""",
    "session_patterns": """
        SELECT session_id, user_id, COUNT(*) AS page_views, COUNT(DISTINCT endpoint) AS unique_pages,
               MIN(timestamp) AS session_start, MAX(timestamp) AS session_end
        FROM logs WHERE session_id IS NOT NULL GROUP BY session_id, user_id
        ORDER BY page_views DESC, session_id, user_id ASC NULLS FIRST LIMIT 10""",
    "error_count": f"SELECT COUNT(*) AS count FROM logs WHERE {ERR}",
    "ip_frequency": """
        SELECT ip_address, COUNT(*) AS requests FROM logs GROUP BY ip_address
        ORDER BY requests DESC, ip_address ASC NULLS FIRST LIMIT 5""",
    "unique_endpoints": "SELECT COUNT(DISTINCT endpoint) AS count FROM logs",
    "null_counts": """
        SELECT COUNT(*) FILTER (WHERE endpoint IS NULL) AS null_endpoints,
               COUNT(*) FILTER (WHERE method IS NULL) AS null_methods,
               COUNT(*) FILTER (WHERE server IS NULL) AS null_servers
        FROM logs""",
    "endpoint_method_pairs": f"""
        SELECT endpoint, method, COUNT(*) AS frequency,
               {pct('COUNT(*)', '(SELECT COUNT(*) FROM logs)')} AS percentage
        FROM logs WHERE endpoint IS NOT NULL AND method IS NOT NULL
        GROUP BY endpoint, method HAVING COUNT(*) > 5
        ORDER BY frequency DESC, endpoint, method LIMIT 10""",
    # fallback branch: a threshold no group reaches, so the top pairs come without it
    "support_fallback": _pairs_with_fallback(2**63 - 1),
    "support_pass_through": _pairs_with_fallback(5),
    "error_patterns": f"""
        SELECT server, endpoint, status_code, COUNT(*) AS frequency
        FROM logs WHERE {ERR} AND server IS NOT NULL AND endpoint IS NOT NULL
        GROUP BY server, endpoint, status_code HAVING COUNT(*) > 2
        ORDER BY frequency DESC, server, endpoint, status_code LIMIT 8""",
    "error_patterns_fallback": f"""
        , g AS (
          SELECT server, endpoint, status_code, COUNT(*) AS frequency
          FROM logs WHERE {ERR} AND server IS NOT NULL AND endpoint IS NOT NULL
          GROUP BY server, endpoint, status_code)
        SELECT * FROM g
        WHERE frequency > 2 OR (SELECT COALESCE(MAX(frequency), 0) FROM g) <= 2
        ORDER BY frequency DESC, server, endpoint, status_code LIMIT 8""",
    "pattern_statistics": """
        SELECT COUNT(DISTINCT endpoint) AS unique_endpoints, COUNT(DISTINCT method) AS unique_methods,
               COUNT(DISTINCT (endpoint, method)) AS unique_combinations,
               COUNT(DISTINCT server) AS unique_servers
        FROM logs WHERE endpoint IS NOT NULL AND method IS NOT NULL""",
    "server_activity": """
        SELECT server, COUNT(*) AS requests, COUNT(DISTINCT endpoint) AS unique_endpoints,
               COUNT(DISTINCT method) AS unique_methods
        FROM logs WHERE server IS NOT NULL GROUP BY server
        ORDER BY requests DESC, server LIMIT 5""",
    "kpi_summary": f"""
        , ep AS (SELECT endpoint, COUNT(*) AS requests FROM logs GROUP BY endpoint
                 ORDER BY requests DESC, endpoint ASC NULLS FIRST LIMIT 1)
        , sv AS (SELECT server, {mean2('response_time')} AS avg_ms FROM logs GROUP BY server
                 ORDER BY avg_ms DESC NULLS LAST, server ASC NULLS FIRST LIMIT 1)
        , tot AS (SELECT COUNT(*) AS total_records, COUNT(*) FILTER (WHERE {ERR}) AS error_count,
                         COUNT(DISTINCT endpoint) AS unique_endpoints FROM logs)
        SELECT total_records, error_count, {pct('error_count', 'total_records', 1)} AS error_percentage,
               unique_endpoints, ep.endpoint AS top_endpoint, ep.requests AS top_endpoint_requests,
               sv.server AS slowest_server, sv.avg_ms AS slowest_server_avg_ms
        FROM tot, ep, sv""",
    "simple_count": "SELECT COUNT(*) AS count FROM logs",
    "level_counts": "SELECT level, COUNT(*) AS count FROM logs GROUP BY level",
    "server_requests_avg": """
        SELECT server, COUNT(*) AS requests, AVG(response_time) AS avg_time
        FROM logs GROUP BY server ORDER BY requests DESC, server ASC NULLS FIRST""",
    "hour_counts": """
        SELECT CAST(hour(timestamp) AS INTEGER) AS hour, COUNT(*) AS requests
        FROM logs GROUP BY 1 ORDER BY 1""",
    "endpoint_method_top20": """
        SELECT endpoint, method, COUNT(*) AS requests FROM logs GROUP BY endpoint, method
        ORDER BY requests DESC, endpoint ASC NULLS FIRST, method ASC NULLS FIRST LIMIT 20""",
    "distinct_endpoints": "SELECT COUNT(*) AS count FROM (SELECT DISTINCT endpoint FROM logs)",
    "server_key_counts": "SELECT server, COUNT(*) AS count FROM logs GROUP BY server",
    "error_server_times": "SELECT server, response_time FROM logs WHERE level = 'ERROR'",
    "time_columns": """
        SELECT *, CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour,
               CAST(dayofweek(timestamp) + 1 AS INTEGER) AS day_of_week
        FROM logs""",
    "sample_rows": "SELECT * FROM logs ORDER BY event_id LIMIT 3",
}


def _profile_sql() -> str:
    from ..schema import LOG_SCHEMA

    columns = [("event_id", "bigint")] + [(f.name, f.dataType.simpleString()) for f in LOG_SCHEMA.fields]
    parts = [
        f"SELECT {i} AS position, '{name}' AS column_name, '{dtype}' AS data_type, "
        f"COUNT(*) AS records, COUNT(*) FILTER (WHERE {name} IS NULL) AS nulls FROM logs"
        for i, (name, dtype) in enumerate(columns, start=1)
    ]
    return "\nUNION ALL ".join(parts)


# Results of the report that have another statement's name here.
_SAME_AS = {"endpoint_method_pairs": "support_pass_through", "error_patterns": "error_patterns_fallback"}

# Naming columns and measures of every result of the report ("@" marks a time, "$" a text, others are numbers).
LONG_FORM: dict[str, tuple[list[str], list[str]]] = {
    "level_distribution": (["level"], ["count", "percentage"]),
    "level_counts": (["level"], ["count"]),
    "top_endpoints": (["endpoint"], ["requests"]),
    "error_analysis": (["status_code"], ["count", "error_rate"]),
    "error_count": ([], ["count"]),
    "server_performance": (["server"], ["total_requests", "avg_response_ms", "max_response_ms"]),
    "server_requests_avg": (["server"], ["requests", "avg_time"]),
    "server_key_counts": (["server"], ["count"]),
    "hourly_traffic": (["hour"], ["requests", "avg_response_time", "errors"]),
    "hour_counts": (["hour"], ["requests"]),
    "daily_traffic": (["date"], ["requests", "avg_response_time", "error_rate"]),
    "ip_frequency": (["ip_address"], ["requests"]),
    "null_counts": ([], ["null_endpoints", "null_methods", "null_servers"]),
    "unique_endpoints": ([], ["count"]),
    "distinct_endpoints": ([], ["count"]),
    "simple_count": ([], ["count"]),
    "endpoint_method_pairs": (["endpoint", "method"], ["frequency", "percentage"]),
    "endpoint_method_top20": (["endpoint", "method"], ["requests"]),
    "error_patterns": (["server", "endpoint", "status_code"], ["frequency"]),
    "pattern_statistics": ([], ["unique_endpoints", "unique_methods", "unique_combinations", "unique_servers"]),
    "server_activity": (["server"], ["requests", "unique_endpoints", "unique_methods"]),
    "kpi_summary": ([], [
        "total_records", "error_count", "error_percentage", "unique_endpoints", "$top_endpoint", "top_endpoint_requests",
        "$slowest_server", "slowest_server_avg_ms",
    ]),
    "user_activity": (["user_id"], ["requests", "sessions", "unique_pages", "avg_response_time"]),
    "session_patterns": (["session_id", "user_id"], ["page_views", "unique_pages", "@session_start", "@session_end"]),
}


def _measure(name: str) -> str:
    kind, column = (name[0], name[1:]) if name[0] in "@$" else ("", name)
    number = "NULL::DOUBLE" if kind else f"CAST({column} AS DOUBLE)"
    text = {"": "NULL::VARCHAR", "$": column, "@": f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"}[kind]
    return f"{{'measure': '{column}', 'number': {number}, 'text': {text}}}"


def _long(names: list[str]) -> str:
    """The named results one below the other, whole."""
    parts = []
    for n in names:
        keys, measures = LONG_FORM[n]
        key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '(null)')" for k in keys) or "''"
        body = _BODIES[_SAME_AS.get(n, n)].strip()
        body = f"WITH {body[1:]}" if body.startswith(",") else body
        parts.append(f"SELECT '{n}' AS result, {key} AS key, unnest([{', '.join(map(_measure, measures))}], recursive := true) FROM ({body})")
    return "\nUNION ALL ".join(parts)


def _in_range(statement: str) -> str:
    """``statement`` over the logs of the range reports' days."""
    return f"""
        , all_logs AS (SELECT * FROM logs)
        SELECT * FROM (
          WITH logs AS (SELECT * FROM all_logs WHERE CAST(timestamp AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-20')
          {statement})"""


_DISTINCT = """
    SELECT 'endpoints' AS metric, NULL::VARCHAR AS key, COUNT(DISTINCT endpoint) AS count, bool_or(endpoint IS NULL) AS has_null FROM logs
    UNION ALL SELECT 'pair_endpoints', NULL, COUNT(DISTINCT endpoint), FALSE FROM logs WHERE endpoint IS NOT NULL AND method IS NOT NULL
    UNION ALL SELECT 'pair_methods', NULL, COUNT(DISTINCT method), FALSE FROM logs WHERE endpoint IS NOT NULL AND method IS NOT NULL
    UNION ALL SELECT 'pair_servers', NULL, COUNT(DISTINCT server), bool_or(server IS NULL) FROM logs
              WHERE endpoint IS NOT NULL AND method IS NOT NULL
    UNION ALL SELECT 'pairs', NULL, COUNT(DISTINCT (endpoint, method)), FALSE FROM logs WHERE endpoint IS NOT NULL AND method IS NOT NULL
    UNION ALL SELECT 'server_endpoints', server, COUNT(DISTINCT endpoint), bool_or(endpoint IS NULL) FROM logs
              WHERE server IS NOT NULL GROUP BY server
    UNION ALL SELECT 'server_methods', server, COUNT(DISTINCT method), bool_or(method IS NULL) FROM logs
              WHERE server IS NOT NULL GROUP BY server"""


# The text line of an event in the landed zones.
_LINE = "(CAST(event_id AS VARCHAR) || ',' || event_type)"

_BODIES.update(
    {
        "scan_json": "SELECT * FROM logs",
        "scan_partitioned": "SELECT *, CAST(timestamp AS DATE) AS date FROM logs",
        "partition_day": """
            SELECT *, CAST(timestamp AS DATE) AS date FROM logs
            WHERE CAST(timestamp AS DATE) = DATE '2024-01-15'""",
        "csv_round_trip": _BODIES["session_patterns"],
        "rejects": """
            SELECT CASE WHEN ip_address LIKE '%.113' THEN 'malformed'
                        WHEN ip_address LIKE '%.142' THEN 'bad_timestamp'
                        ELSE 'accepted' END AS status,
                   COUNT(*) AS records
            FROM logs GROUP BY 1""",
        "scan_mixed_types": """
            SELECT * REPLACE (response_time + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS response_time)
            FROM logs""",
        "ingest_rejects": """
            SELECT CASE WHEN ip_address LIKE '%.113' THEN 'malformed'
                        WHEN ip_address LIKE '%.142' THEN 'bad_timestamp'
                        WHEN ip_address LIKE '%.121' THEN 'bad_number'
                        ELSE 'accepted' END AS status,
                   COUNT(*) AS records
            FROM logs GROUP BY 1""",
        "sql_logs_time": f"""
            SELECT CAST(timestamp AS DATE) AS date, CAST(hour(timestamp) AS INTEGER) AS hour, COUNT(*) AS requests,
                   COUNT(*) FILTER (WHERE {ERR}) AS errors, (SELECT COUNT(*) FROM logs) AS all_requests
            FROM logs GROUP BY 1, 2 ORDER BY 1, 2""",
        "saved_report": _long(list(LONG_FORM)),
        "one_scan_report": _long(list(LONG_FORM)),
        "daily_report": _long(list(LONG_FORM)),
        "daily_range": _in_range(_long(list(LONG_FORM))),
        "distinct_range": _in_range(_DISTINCT),
        "heavy_endpoints": _BODIES["top_endpoints"],
        "heavy_addresses": _BODIES["ip_frequency"],
        "heavy_users": _BODIES["user_activity"],
        "heavy_sessions": _BODIES["session_patterns"],
        "packed_table": "SELECT CAST(timestamp AS DATE) AS date, COUNT(*) AS records, TRUE AS packed FROM logs GROUP BY 1",
        "lookup_rows": """
            SELECT 'user_id' AS by, event_id FROM logs WHERE user_id = (SELECT MAX(user_id) FROM logs)
            UNION ALL SELECT 'session_id', event_id FROM logs WHERE session_id = (SELECT MAX(session_id) FROM logs)
            UNION ALL SELECT 'ip_address', event_id FROM logs WHERE ip_address = (SELECT MIN(ip_address) FROM logs)""",
        "sql_functions": """
            SELECT 'endpoints' AS report, endpoint AS key, n FROM (SELECT endpoint, COUNT(*) AS n FROM logs GROUP BY endpoint
                ORDER BY n DESC, endpoint NULLS FIRST LIMIT 7)
            UNION ALL SELECT 'addresses', ip_address, n FROM (SELECT ip_address, COUNT(*) AS n FROM logs GROUP BY ip_address
                ORDER BY n DESC, ip_address NULLS FIRST LIMIT 5)
            UNION ALL SELECT 'users', user_id, n FROM (SELECT user_id, COUNT(*) AS n FROM logs WHERE user_id IS NOT NULL
                GROUP BY user_id ORDER BY n DESC, user_id LIMIT 20)
            UNION ALL SELECT 'sessions', session_id, n FROM (SELECT session_id, user_id, COUNT(*) AS n FROM logs
                WHERE session_id IS NOT NULL GROUP BY session_id, user_id ORDER BY n DESC, session_id, user_id NULLS FIRST LIMIT 3)
            UNION ALL SELECT 'pairs', endpoint || ' ' || method, n FROM (SELECT endpoint, method, COUNT(*) AS n FROM logs
                WHERE endpoint IS NOT NULL AND method IS NOT NULL GROUP BY endpoint, method HAVING COUNT(*) > 3
                ORDER BY n DESC, endpoint, method LIMIT 12)
            UNION ALL SELECT 'errors', server || ' ' || endpoint || ' ' || status_code, n FROM (
                SELECT server, endpoint, status_code, COUNT(*) AS n FROM logs
                WHERE status_code >= 500 AND server IS NOT NULL AND endpoint IS NOT NULL
                GROUP BY server, endpoint, status_code HAVING COUNT(*) > 2 ORDER BY n DESC, server, endpoint, status_code LIMIT 6)
            UNION ALL SELECT 'traffic', CAST(timestamp AS DATE) || ' ' || hour(timestamp),
                COUNT(*) * 1000 + COUNT(*) FILTER (WHERE status_code >= 400)
                FROM logs WHERE timestamp >= TIMESTAMP '2024-01-10 06:00:00' AND timestamp < TIMESTAMP '2024-01-12 00:00:00'
                GROUP BY CAST(timestamp AS DATE), hour(timestamp)
            UNION ALL SELECT 'slow', server, MAX(response_time) FROM logs GROUP BY server
                HAVING (200 * SUM(response_time) + COUNT(response_time)) // (2 * COUNT(response_time)) >= 30000""",
        "zone_usage": f"""
            SELECT 'events' AS zone, CAST(SUM(strlen({_LINE}) + 1) AS BIGINT) AS bytes FROM events
            UNION ALL
            SELECT 'errors', CAST(SUM(strlen({_LINE}) + 1) AS BIGINT) FROM events WHERE event_type = 'error'""",
        "file_inventory": f"""
            SELECT 'events' AS zone, 'present' AS status, CAST(SUM(strlen({_LINE}) + 1) AS BIGINT) AS bytes,
                   COUNT(*) AS rows FROM events
            UNION ALL
            SELECT 'errors', 'present', CAST(SUM(strlen({_LINE}) + 1) AS BIGINT), COUNT(*)
            FROM events WHERE event_type = 'error'
            UNION ALL SELECT 'nothing', 'empty', 0, 0
            UNION ALL SELECT 'nowhere', 'absent', 0, 0""",
        "partition_profile": "SELECT COUNT(*) AS records, TRUE AS consistent FROM logs",
        "profile_input": _profile_sql(),
        "stream_ingest": "SELECT *, CAST(timestamp AS DATE) AS date FROM logs",
        "stream_replay": "SELECT *, CAST(timestamp AS DATE) AS date FROM logs",
        "manifest_usage": f"""
            SELECT 'events' AS zone, CAST(SUM(strlen({_LINE}) + 1) AS BIGINT) AS bytes, TRUE AS checked FROM events
            UNION ALL
            SELECT 'errors', CAST(SUM(strlen({_LINE}) + 1) AS BIGINT), TRUE FROM events WHERE event_type = 'error'""",
        "bucketed_users": _BODIES["user_activity"],
        "bucketed_sessions": _BODIES["session_patterns"],
    }
)


def oracle_queries(logs_sql: str = LOG_VIEW_SQL) -> dict[str, str]:
    """Key -> complete DuckDB statement.

    By default the log view is derived from the pre-registered ``events``
    table; ``logs_sql`` may name any other relation of log records (tests run
    the same statements over hand-made rows).
    """
    # a body either is a SELECT or continues the WITH list (", name AS (...)")
    return {key: f"WITH logs AS ({logs_sql})\n{body.strip()}" for key, body in _BODIES.items()}
