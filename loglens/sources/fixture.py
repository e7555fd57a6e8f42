"""A log view derived from the ``events`` table.

The test data has no web-log table, so the log record is derived from
``events(event_id, ts, user_id, event_type, value, props)`` by one fixed
expression per column. It is a pure projection (no shuffle, no UDF): at any
scale it costs one pass over the columns it needs, and Catalyst prunes the
``events`` columns a query does not use.

Endpoints and servers come from the event's type, number and user, so their
number grows with the table. The same view is written for DuckDB in
:mod:`loglens.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of a web-log record: HTTP methods and status codes, client
# platforms, and the event type -> log level map (any other type is INFO).
METHODS = ["GET", "POST", "PUT", "DELETE"]
ERROR_CODES = [400, 401, 403, 404, 500, 502, 503]
SUCCESS_CODES = [200, 201, 202, 204]
USER_AGENTS = ["Windows", "Macintosh", "Linux"]
LEVEL_OF_EVENT = {"error": "ERROR", "signup": "DEBUG", "purchase": "WARN"}
# ---------------------------------------------------------------------------


def _pick(values: list, index: Column) -> Column:
    """``values[index]`` with a 0-based integer index column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index.cast("int") + 1)


def logs_from_events(events: DataFrame) -> DataFrame:
    """Map ``events`` rows to log records (``event_id`` + ``LOG_SCHEMA``)."""
    k = F.get_json_object("props", "$.k").cast("int")
    eid = F.col("event_id")
    uid = F.col("user_id")
    is_err = F.col("event_type") == "error"

    # every fifth event asks for a page that few others do: their number grows with the table
    page = F.when(eid % 5 == 0, F.lit(100) + F.floor(eid / 40).cast("bigint")).otherwise((k % 10).cast("bigint"))

    level_of = F.create_map(*[F.lit(x) for pair in LEVEL_OF_EVENT.items() for x in pair])
    level = F.coalesce(level_of[F.col("event_type")], F.lit("INFO"))

    return events.select(
        eid.alias("event_id"),
        F.col("ts").alias("timestamp"),
        level.alias("level"),
        F.when(k % 25 == 7, F.lit(None)).otherwise(F.concat(F.lit("server-"), (uid % 101).cast("string"))).alias("server"),
        F.concat(F.lit("app-"), (k % 4).cast("string")).alias("application"),
        F.concat(F.lit("192.168."), (uid % 10 + 1).cast("string"), F.lit("."), (k + 100).cast("string")).alias(
            "ip_address"
        ),
        F.when(eid % 89 == 0, F.lit(None)).otherwise(_pick(METHODS, (eid % 7) % 4)).alias("method"),
        F.when(eid % 97 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), page.cast("string")))
        .alias("endpoint"),
        F.when(eid % 101 == 0, F.lit(None))
        .when(is_err, _pick(ERROR_CODES, eid % 7))
        .otherwise(_pick(SUCCESS_CODES, eid % 4))
        .cast("bigint")
        .alias("status_code"),
        (F.floor(F.col("value") * 10).cast("bigint") + F.when(is_err, 100).otherwise(50)).alias("response_time"),
        F.when(uid % 20 == 3, F.lit(None))
        .otherwise(F.concat(F.lit("user_"), (uid + 1000).cast("string")))
        .alias("user_id"),
        F.when(eid % 50 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("sess_"), uid.cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd")))
        .alias("session_id"),
        (F.lit(500) + ((eid % 49501) * 37) % 49501).alias("bytes_sent"),
        _pick(USER_AGENTS, eid % 3).alias("user_agent"),
    )


def load_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log view over ``{sf_dir}/events.parquet``."""
    return logs_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
