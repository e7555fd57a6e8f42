"""Log tables bucketed by user, for reports over high-cardinality keys.

Ranking users or sessions groups every row by its key. Stored in buckets of the user's hash, all rows of a
user, and so of each of the user's sessions, are read by one task, and Spark plans these groupings without a
shuffle: the table is shuffled once, when it is written, and not for every report.

A bucket is read by one task. Give the table enough buckets for one to fit a task
(rows / buckets), and use the sketch (:mod:`loglens.operators.heavy_hitters`) where one user may hold a large
part of all rows. The table is registered in the session's catalog under ``name``; its files are at ``path``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path
from ..sinks.packing import session_conf

BUCKET_KEY = "user_id"


def store_bucketed(spark: SparkSession, logs: DataFrame, name: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write ``logs`` in ``buckets`` buckets by user and return the table.

    The rows are dealt by the same hash first, so a bucket is one file, written by one task.
    """
    path = path or fresh_path(spark, f"bucketed-{name}")
    # a coalesced shuffle would still be right, but write a bucket's rows from fewer tasks
    with session_conf(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        dealt = logs.repartition(buckets, F.col(BUCKET_KEY))
        dealt.write.mode("overwrite").bucketBy(buckets, BUCKET_KEY).sortBy(BUCKET_KEY).option("path", path).saveAsTable(name)
    return spark.table(name)
