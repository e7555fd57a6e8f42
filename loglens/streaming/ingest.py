"""Incremental landing: new JSON log files -> typed, date-partitioned Parquet.

Log files keep arriving in a raw zone. Re-reading the whole zone for every
analysis parses the same JSON again and again; instead, a Structured
Streaming file source picks up only the files it has not seen (tracked in the
checkpoint), parses them once with the fixed schema and appends typed rows to
a Parquet table partitioned by ``date``. With ``availableNow`` the query
processes everything present and stops, so it can run as a scheduled batch
job; a lost executor or a killed run resumes from the checkpoint without
duplicating or skipping files.

A producer may send a drop again under new file names. With ``key`` (a column that names a
record), every record that was ingested in the last ``remember`` is known in the stream's state, and
its repetitions are left out. The state's clock is the time of arrival, not the time in the line: a line is
never late. However old it is, it lands under its own date; only a repetition that arrives after
``remember`` lands again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..schema import CORRUPT_COLUMN, RAW_SCHEMA
from ..sinks.packing import session_conf
from ..sources.json_logs import PARTITION_COLUMN, RAW_LINE, REJECT_REASON, mark_rejects, text_reader_schema

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# First partition column of an ingested table.
STATUS, ACCEPTED, REJECTED = "status", "accepted", "rejected"


def marked_log_stream(
    spark: SparkSession,
    raw_dir: str,
    schema: StructType = RAW_SCHEMA,
    max_files_per_trigger: int | None = None,
    archive_dir: str | None = None,
    zone_aware: bool = True,
) -> DataFrame:
    """Streaming frame of the lines of JSON Lines files under ``raw_dir``, typed, with
    ``reject_reason``, ``raw_line`` and the partition columns ``status`` and ``date``.

    With ``archive_dir``, files are moved there once their batch is committed
    (those of a run's last batch at the next run), so the raw zone, listed on
    every run, holds few files besides the ones not yet ingested.
    """
    reader = spark.readStream.schema(text_reader_schema(schema)).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    marked = mark_rejects(reader.json(raw_dir), schema, zone_aware)
    status = F.when(F.col(REJECT_REASON).isNull(), ACCEPTED).otherwise(REJECTED)
    return marked.withColumns({STATUS: status, PARTITION_COLUMN: F.to_date("timestamp")})


def without_repetitions(stream: DataFrame, key: str, remember: str) -> DataFrame:
    """``stream`` without records whose ``key`` arrived before, as far back as ``remember``."""
    known = F.col(key).cast("string")
    record = F.coalesce(F.concat(F.lit("k"), known), F.concat(F.lit("l"), F.sha2(F.coalesce(RAW_LINE, F.lit("")), 256)))
    timed = stream.withColumns({"_record": record, "_arrived": F.current_timestamp()})
    return timed.withWatermark("_arrived", remember).dropDuplicatesWithinWatermark(["_record"]).drop("_record", "_arrived")


def ingest(
    spark: SparkSession,
    raw_dir: str,
    table_dir: str,
    checkpoint_dir: str,
    schema: StructType = RAW_SCHEMA,
    max_files_per_trigger: int | None = None,
    wait: bool = True,
    archive_dir: str | None = None,
    zone_aware: bool = True,
    files_per_date: int | None = None,
    key: str | None = None,
    remember: str = "7 days",
) -> StreamingQuery:
    """Append the not yet ingested files of ``raw_dir`` to the Parquet table at ``table_dir``.

    Accepted records land in ``status=accepted/date=.../``, rejected lines with
    their reason in ``status=rejected``: one parse and one exactly-once sink for
    both. ``checkpoint_dir`` must be on shared storage and stay with the table;
    it records which files are done. ``max_files_per_trigger`` splits a large
    backlog into bounded batches; ``archive_dir`` (outside ``raw_dir``) moves
    ingested files away so later runs list only new ones. A batch's rows are
    dealt by date and a salt, so it writes at most ``files_per_date`` files per
    date and a busy day is shared by that many tasks (by default a quarter of
    ``spark.sql.shuffle.partitions``, which is sized with the input, and 8 at least); 0 leaves the rows where
    they are (no shuffle, for files in time order). With ``key``, repetitions of a record within
    ``remember`` are left out; a line without a key, such as a malformed one, is its own key. Keep ``key`` and
    ``spark.sql.shuffle.partitions`` with the checkpoint. Returns the (finished, when ``wait``) query.
    """
    stream = marked_log_stream(spark, raw_dir, schema, max_files_per_trigger, archive_dir, zone_aware)
    if key:
        stream = without_repetitions(stream, key, remember)
    if files_per_date is None:
        files_per_date = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    if files_per_date:
        salt = F.pmod(F.xxhash64(*[c for c in schema.names]), F.lit(files_per_date))
        stream = stream.repartition(F.col(STATUS), F.col(PARTITION_COLUMN), salt)
    writer = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint_dir)
        .partitionBy(STATUS, PARTITION_COLUMN)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    # the keys live on the executors' disks and in the checkpoint, not in their heaps
    with session_conf(spark, {STATE_STORE: ROCKSDB} if key else {}):
        query = writer.start(table_dir)
    if wait:
        query.awaitTermination()
    return query


def read_ingested(spark: SparkSession, table_dir: str, dates: Iterable[str | dt.date] | None = None) -> DataFrame:
    """The accepted records of an ingested table, of all or some ``dates`` (only committed batches are visible)."""
    table = spark.read.parquet(table_dir).filter(F.col(STATUS) == ACCEPTED)
    if dates is not None:
        wanted = [d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in dates]
        table = table.filter(F.col(PARTITION_COLUMN).isin(wanted))
    return table.drop(STATUS, REJECT_REASON, RAW_LINE)


def read_ingest_rejects(spark: SparkSession, table_dir: str) -> DataFrame:
    """``reject_reason, raw_line`` of the rejected lines of an ingested table."""
    return spark.read.parquet(table_dir).filter(F.col(STATUS) == REJECTED).select(REJECT_REASON, RAW_LINE)


def ingest_summary(spark: SparkSession, table_dir: str) -> DataFrame:
    """``status, records``: accepted records and rejects per reason of an ingested table."""
    status = F.coalesce(F.col(REJECT_REASON), F.col(STATUS)).alias("status")
    return spark.read.parquet(table_dir).groupBy(status).agg(F.count("*").alias("records"))
