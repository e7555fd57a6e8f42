"""Fixed schemas of the log record and of the analysis results.

``RAW_SCHEMA`` is the shape of a JSON Lines log file (the timestamp is text, as
written by log producers). ``LOG_SCHEMA`` is the typed record every analysis
works on: the timestamp is a UTC wall clock (``TIMESTAMP_NTZ``), so date and
hour never depend on the session time zone.

Reading with a fixed schema avoids an inference pass over the input (a full
extra scan at 100 TB) and schema drift between files.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Field order of a log record.
LOG_FIELDS = [
    "timestamp",
    "level",
    "server",
    "application",
    "ip_address",
    "method",
    "endpoint",
    "status_code",
    "response_time",
    "user_id",
    "session_id",
    "bytes_sent",
    "user_agent",
]

_LONG_FIELDS = {"status_code", "response_time", "bytes_sent"}


def _record_schema(timestamp_type) -> StructType:
    fields = []
    for name in LOG_FIELDS:
        if name == "timestamp":
            dtype = timestamp_type
        elif name in _LONG_FIELDS:
            dtype = LongType()
        else:
            dtype = StringType()
        fields.append(StructField(name, dtype, True))
    return StructType(fields)


RAW_SCHEMA = _record_schema(StringType())
LOG_SCHEMA = _record_schema(TimestampNTZType())

# Name of the column that PERMISSIVE JSON parsing fills for unparsable lines.
CORRUPT_COLUMN = "_corrupt_record"


def with_field(schema: StructType, name: str, dtype, position: int | None = None) -> StructType:
    """Return ``schema`` with one more nullable field (appended by default)."""
    fields = list(schema.fields)
    field = StructField(name, dtype, True)
    if position is None:
        fields.append(field)
    else:
        fields.insert(position, field)
    return StructType(fields)


def _struct(*cols) -> StructType:
    return StructType([StructField(n, t, True) for n, t in cols])


# Result schemas of the named analyses (used to read saved results back).
RESULT_SCHEMAS: dict[str, StructType] = {
    "level_distribution": _struct(("level", StringType()), ("count", LongType()), ("percentage", DoubleType())),
    "top_endpoints": _struct(("endpoint", StringType()), ("requests", LongType())),
    "error_analysis": _struct(("status_code", LongType()), ("count", LongType()), ("error_rate", DoubleType())),
    "server_performance": _struct(
        ("server", StringType()),
        ("total_requests", LongType()),
        ("avg_response_ms", DoubleType()),
        ("max_response_ms", LongType()),
    ),
    "hourly_traffic": _struct(
        ("hour", IntegerType()),
        ("requests", LongType()),
        ("avg_response_time", DoubleType()),
        ("errors", LongType()),
    ),
    "daily_traffic": _struct(
        ("date", DateType()),
        ("requests", LongType()),
        ("avg_response_time", DoubleType()),
        ("error_rate", DoubleType()),
    ),
    "user_activity": _struct(
        ("user_id", StringType()),
        ("requests", LongType()),
        ("sessions", LongType()),
        ("unique_pages", LongType()),
        ("avg_response_time", DoubleType()),
    ),
    "session_patterns": _struct(
        ("session_id", StringType()),
        ("user_id", StringType()),
        ("page_views", LongType()),
        ("unique_pages", LongType()),
        ("session_start", TimestampNTZType()),
        ("session_end", TimestampNTZType()),
    ),
    "ip_frequency": _struct(("ip_address", StringType()), ("requests", LongType())),
    "null_counts": _struct(("null_endpoints", LongType()), ("null_methods", LongType()), ("null_servers", LongType())),
    "endpoint_method_pairs": _struct(
        ("endpoint", StringType()),
        ("method", StringType()),
        ("frequency", LongType()),
        ("percentage", DoubleType()),
    ),
    "error_patterns": _struct(
        ("server", StringType()),
        ("endpoint", StringType()),
        ("status_code", LongType()),
        ("frequency", LongType()),
    ),
    "pattern_statistics": _struct(
        ("unique_endpoints", LongType()),
        ("unique_methods", LongType()),
        ("unique_combinations", LongType()),
        ("unique_servers", LongType()),
    ),
    "server_activity": _struct(
        ("server", StringType()),
        ("requests", LongType()),
        ("unique_endpoints", LongType()),
        ("unique_methods", LongType()),
    ),
}
