"""User and session activity: top-k reports over high-cardinality keys.

Only the ranking measure (requests, page views) is needed for every user or
session; the distinct counts are needed for the k winners alone. So each
report runs in two passes, whatever k is:

1. one single-level aggregate ranks all keys (map-side partial step, then a
   shuffle of one partial row per key and task) and ``TakeOrderedAndProject``
   keeps the k best;
2. those k rows are joined to the rows (Spark broadcasts them as long as their
   size, known from the limit, is below its threshold), so the distinct counts
   aggregate only the winners' rows.

The exact distinct counts of the second pass are planned as two aggregation
levels (first by key and value, then by key), each with a map-side partial
step, so even a winner holding a third of all rows never lands whole in one
task. The rows are scanned twice: run these over the columnar log table, not
over raw JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import rows_of_top, top_k

USER_COLUMNS = ["user_id", "requests", "sessions", "unique_pages", "avg_response_time"]
SESSION_COLUMNS = ["session_id", "user_id", "page_views", "unique_pages", "session_start", "session_end"]


def user_activity(logs: DataFrame, k: int = 15) -> DataFrame:
    """``user_id, requests, sessions, unique_pages, avg_response_time`` for the ``k`` busiest users."""
    users = logs.filter(F.col("user_id").isNotNull())
    ranking = [F.count("*").alias("requests"), F.round(F.avg("response_time"), 2).alias("avg_response_time")]
    distincts = [F.count_distinct("session_id").alias("sessions"), F.count_distinct("endpoint").alias("unique_pages")]
    order = {"desc": ["requests"], "asc": ["user_id"]}
    top = top_k(users.groupBy("user_id").agg(*ranking), k, **order)
    detail = rows_of_top(users, top, ["user_id"]).groupBy(*top.columns).agg(*distincts)
    return top_k(detail, k, **order).select(*USER_COLUMNS)


def session_patterns(logs: DataFrame, k: int = 10) -> DataFrame:
    """``session_id, user_id, page_views, unique_pages, session_start, session_end``.

    The ``k`` sessions with most page views; a NULL user is kept as part of
    the key, a NULL session is not a session.
    """
    sessions = logs.filter(F.col("session_id").isNotNull())
    keys = ["session_id", "user_id"]
    ranking = [
        F.count("*").alias("page_views"),
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
    ]
    distinct = F.count_distinct("endpoint").alias("unique_pages")
    order = {"desc": ["page_views"], "asc": keys}
    top = top_k(sessions.groupBy(*keys).agg(*ranking), k, **order)
    detail = rows_of_top(sessions, top, keys).groupBy(*top.columns).agg(distinct)
    return top_k(detail, k, **order).select(*SESSION_COLUMNS)
