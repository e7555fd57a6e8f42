"""Hand-made log rows for edge-case tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loglens.schema import LOG_FIELDS, RAW_SCHEMA
from loglens.sources.json_logs import to_typed

DEFAULT_TS = "2024-01-01T10:00:00Z"


def make_logs(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Typed logs from dicts of log fields (missing fields are NULL; a default timestamp)."""
    data = []
    for r in rows:
        r = {"timestamp": DEFAULT_TS, **r}
        data.append(tuple(r.get(f) for f in LOG_FIELDS))
    return to_typed(spark.createDataFrame(data, RAW_SCHEMA))
