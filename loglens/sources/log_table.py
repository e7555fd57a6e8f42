"""The log table: typed records stored once as Parquet, partitioned by date.

Deriving a log record (JSON property lookup, string building) costs far more per
row than any analysis over it, and a raw input may arrive as few large files.
Writing the typed records once into the cluster's shared folder gives every
later analysis a columnar scan that reads only the columns it uses, with
directories to prune by day, and a table that outlives lost executors (unlike a
cache) and cuts the lineage back to the raw input.

Rows are packed by date (:mod:`loglens.sinks.packing`): about one file per date and
128 MB, whatever the order of the input; only input in time order may skip that shuffle.
Tables are written under ``<spark.checkpoint.dir>/loglens/`` and never deleted by
the library; give that prefix a lifecycle rule, or delete it between runs.
Input that is already such a table (or an ingested one, see
:mod:`loglens.streaming`) is read as it is, without a copy.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from ..schema import with_field
from ..session import fresh_path, session_key
from ..sinks.packing import FILE_BYTES, write_packed
from .fixture import logs_from_events
from .json_logs import PARTITION_COLUMN
from .results import file_inventory

# per input and state of it: the opened table (its files are listed once)
_TABLES: dict[tuple, DataFrame] = {}


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared folder and return a scan of it."""
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store_logs(
    spark: SparkSession,
    logs: DataFrame,
    columns: Sequence[str] | None = None,
    file_bytes: int = FILE_BYTES,
    sort_by: Sequence[str] = (),
    cluster: bool = True,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
) -> str:
    """Write ``logs`` (or some ``columns`` of them) partitioned by ``date``; returns the path (a new one by default).

    Rows are packed into files of about ``file_bytes`` per date, sorted by
    ``sort_by`` inside a file. ``cluster=False`` writes them where they are, without a shuffle:
    only for input in time order, as each task writes a file for every date that it holds.
    """
    out = (logs.select(*columns) if columns else logs).withColumn(PARTITION_COLUMN, F.to_date("timestamp"))
    path = path or fresh_path(spark, "log-table")
    if cluster:
        return write_packed(out, path, [PARTITION_COLUMN], file_bytes, sort_by, options=options)
    out.write.options(**(options or {})).partitionBy(PARTITION_COLUMN).parquet(path)
    return path


def read_log_table(
    spark: SparkSession, path: str, dates: Iterable[str | dt.date] | None = None, schema: StructType | None = None
) -> DataFrame:
    """The logs stored under ``path``, of all or some ``dates`` (directory pruning).

    With their ``schema`` no file is read to find it.
    """
    reader = spark.read.schema(with_field(schema, PARTITION_COLUMN, DateType())) if schema else spark.read
    table = reader.parquet(path)
    if dates is not None:
        wanted = [d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in dates]
        table = table.filter(F.col(PARTITION_COLUMN).isin(wanted))
    return table.drop(PARTITION_COLUMN)


def _input_state(spark: SparkSession, path: str) -> tuple:
    """What changes when the files below ``path`` change.

    A path without a scheme that the driver sees is looked up there; any other
    is listed by Spark and reduced to one row, whatever the number of files.
    """
    if "://" not in path and os.path.exists(path):
        files = [path] if os.path.isfile(path) else [os.path.join(d, f) for d, _, names in os.walk(path) for f in names]
        return tuple(sorted((f, s.st_size, s.st_mtime_ns) for f in files for s in [os.stat(f)]))
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    row = file_inventory(spark, path).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.sum(each).alias("state")).first()
    return tuple(row)


def log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log view over ``{sf_dir}/events.parquet``, stored once per application and state of the input files."""
    path = f"{sf_dir}/events.parquet"
    key = (session_key(spark), path, _input_state(spark, path))
    if key not in _TABLES:
        logs = logs_from_events(spark.read.parquet(path))
        _TABLES[key] = read_log_table(spark, store_logs(spark, logs), schema=logs.schema)
    return _TABLES[key]
