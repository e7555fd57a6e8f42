"""JSON Lines log files: plain, date-partitioned, and the split of bad records.

Files are read with a fixed schema (no inference pass). Timestamps and numbers
are read as text and cast once, right after the scan, so no value is lost to
the way its producer wrote it:

* a number may be quoted, fractional or in exponent form; a BIGINT field keeps
  it rounded half up to a whole number;
* a timestamp becomes a UTC wall clock (``TIMESTAMP_NTZ``); an explicit offset
  such as ``Z`` or ``+05:00`` is applied, a time without one is taken as UTC.

A line is a reject only if it is not a JSON object, or if a timestamp or number
does not cast. The readers return the accepted records;
:func:`read_with_rejects` keeps both, with the reason.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from ..schema import CORRUPT_COLUMN, RAW_SCHEMA, with_field

PARTITION_COLUMN = "date"
REJECT_REASON = "reject_reason"
RAW_LINE = "raw_line"


# An explicit offset at the end of a timestamp text: sign, hours, minutes.
OFFSET = r"\d([+-])(\d{2}):?(\d{2})?$"


def parse_timestamp(text: str | Column = "timestamp", zone_aware: bool = True) -> Column:
    """ISO-8601 text -> ``TIMESTAMP_NTZ`` UTC wall clock; NULL when it does not parse.

    An explicit offset is subtracted from the wall clock in the text, which does
    not depend on the session time zone; ``Z`` and no offset both mean UTC. With
    ``zone_aware=False`` the offset is ignored and the wall clock kept.
    """
    c = F.col(text) if isinstance(text, str) else text
    wall = c.try_cast("timestamp_ntz")
    if not zone_aware:
        return wall
    # only a text with a time of day can have an offset (a date ends in "-dd" too)
    has = c.rlike(OFFSET) & c.contains(":")
    part = lambda i: F.coalesce(F.regexp_extract(c, OFFSET, i).try_cast("int"), F.lit(0))
    minutes = part(2) * 60 + part(3)
    shift = F.make_dt_interval(mins=F.when(F.regexp_extract(c, OFFSET, 1) == "-", minutes).otherwise(-minutes))
    return F.when(c.endswith("Z"), wall).when(has, wall + shift).otherwise(wall)


def to_typed(raw: DataFrame, zone_aware: bool = True) -> DataFrame:
    """Replace the text ``timestamp`` by its parsed value (column order kept)."""
    return raw.withColumn("timestamp", parse_timestamp("timestamp", zone_aware))


def parse_long(text: Column) -> Column:
    """Number text -> BIGINT, fractions rounded half up; NULL when it is no number or too large."""
    whole = text.try_cast("bigint")  # NULL for a fraction or an exponent; those go the longer way
    return F.coalesce(whole, F.round(text.try_cast("decimal(38,9)"), 0).try_cast("bigint"))


def _text_schema(schema: StructType) -> StructType:
    """``schema`` with its BIGINT fields as text."""
    return StructType([StructField(f.name, StringType(), True) if isinstance(f.dataType, LongType) else f for f in schema])


def mark_rejects(raw: DataFrame, schema: StructType, zone_aware: bool = True) -> DataFrame:
    """Typed columns of ``schema`` from a scan of its text form, with ``reject_reason`` and ``raw_line``.

    ``raw_line`` is the line of a malformed record, else the texts of a rejected one.
    """
    numbers = [f.name for f in schema if isinstance(f.dataType, LongType)]
    typed = {n: parse_long(F.col(n)) for n in numbers}
    typed["timestamp"] = parse_timestamp("timestamp", zone_aware)
    lost = lambda n: F.col(n).isNotNull() & typed[n].isNull()
    bad_number = functools.reduce(lambda a, b: a | b, [lost(n) for n in numbers], F.lit(False))
    reason = (
        F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("malformed"))
        .when(lost("timestamp"), F.lit("bad_timestamp"))
        .when(bad_number, F.lit("bad_number"))
    )
    texts = F.to_json(F.struct(*[f.name for f in schema]))
    rest = [c for c in raw.columns if c not in schema.names and c != CORRUPT_COLUMN]
    return raw.select(
        *[typed[n].alias(n) if n in typed else F.col(n) for n in schema.names],
        *rest,
        reason.alias(REJECT_REASON),
        F.when(reason.isNotNull(), F.coalesce(F.col(CORRUPT_COLUMN), texts)).alias(RAW_LINE),
    )


def text_reader_schema(schema: StructType) -> StructType:
    """What a JSON scan for :func:`mark_rejects` must read."""
    return with_field(_text_schema(schema), CORRUPT_COLUMN, StringType())


def _scan(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_COLUMN).json(path)


def read_with_rejects(
    spark: SparkSession, path: str | list[str], schema: StructType = RAW_SCHEMA, zone_aware: bool = True
) -> DataFrame:
    """All lines of ``path``, typed, with ``reject_reason`` (NULL when accepted) and ``raw_line``.

    A line is rejected as ``malformed`` when it is not a JSON object, as
    ``bad_timestamp`` or ``bad_number`` when such a text does not cast. A missing
    (NULL) value is not a reject.
    """
    return mark_rejects(_scan(spark, path, text_reader_schema(schema)), schema, zone_aware)


def split_rejects(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)`` from :func:`read_with_rejects`: the typed records, and
    ``reject_reason, raw_line`` of the others."""
    accepted = marked.filter(F.col(REJECT_REASON).isNull()).drop(REJECT_REASON, RAW_LINE)
    rejected = marked.filter(F.col(REJECT_REASON).isNotNull()).select(REJECT_REASON, RAW_LINE)
    return accepted, rejected


def read_json_logs(
    spark: SparkSession, path: str | list[str], schema: StructType = RAW_SCHEMA, zone_aware: bool = True
) -> DataFrame:
    """Typed logs from a file, directory or glob of JSON Lines, without the rejects.

    Plain or splittably compressed files are split across tasks; gzip files are
    read whole, one task each, so land large logs uncompressed or in a
    splittable codec.
    """
    return split_rejects(read_with_rejects(spark, path, schema, zone_aware))[0]


def read_partitioned_with_rejects(
    spark: SparkSession,
    base: str,
    dates: Iterable[str | dt.date] | None = None,
    schema: StructType = RAW_SCHEMA,
    zone_aware: bool = True,
) -> DataFrame:
    """All lines of a ``date=YYYY-MM-DD/`` layout under ``base``, as :func:`read_with_rejects`.

    ``date`` is the partition column (DATE) the line was filed under. Filtering
    it here, or on the returned frame before
    :func:`~loglens.functions.with_time_columns` replaces it, prunes whole
    directories (``PartitionFilters`` in the plan).
    """
    raw = _scan(spark, base, with_field(text_reader_schema(schema), PARTITION_COLUMN, DateType()))
    if dates is not None:
        wanted = [d if isinstance(d, dt.date) else dt.date.fromisoformat(d) for d in dates]
        raw = raw.filter(F.col(PARTITION_COLUMN).isin(wanted))
    return mark_rejects(raw, schema, zone_aware)


def read_partitioned_logs(
    spark: SparkSession,
    base: str,
    dates: Iterable[str | dt.date] | None = None,
    schema: StructType = RAW_SCHEMA,
    zone_aware: bool = True,
) -> DataFrame:
    """Typed logs from a ``date=YYYY-MM-DD/`` layout (optionally some ``dates``), without the rejects."""
    return split_rejects(read_partitioned_with_rejects(spark, base, dates, schema, zone_aware))[0]


def reject_summary(marked: DataFrame) -> DataFrame:
    """``status, records``: accepted lines and rejects per reason."""
    status = F.coalesce(F.col(REJECT_REASON), F.lit("accepted")).alias("status")
    return marked.groupBy(status).agg(F.count("*").alias("records"))
