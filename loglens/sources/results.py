"""Reading saved results and listing stored files."""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sinks.landing import CSV_TIMESTAMP_NTZ


def read_result_csv(spark: SparkSession, path: str, schema: StructType, null_value: str | None = None) -> DataFrame:
    """A saved CSV result, typed by its result schema (never inferred).

    ``null_value`` must match the one the result was saved with. Quoted fields
    may contain line breaks, so each file is parsed whole (``multiLine``) by
    one task; a large result is saved as many part files, read in parallel.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("timestampNTZFormat", CSV_TIMESTAMP_NTZ)
    )
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    return reader.csv(path)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modificationTime`` of every file below ``path``.

    Uses the binary-file source with only metadata columns selected, so file
    contents are never read; the listing itself runs distributed for large
    directory trees. Hidden and ``_``-prefixed files (checksums, markers) are
    skipped, as by every Spark reader. As for any Spark file scan, the list of
    files is held by the driver; for trees of many millions of files, list
    one zone or date directory at a time.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", "modificationTime")
    )


def _below(column: str, base: str) -> Column:
    """``column`` (a file URI) from ``base`` on; empty when it is not below it."""
    base_path = urlparse(base).path.rstrip("/") if "://" in base or base.startswith("file:") else base.rstrip("/")
    return F.regexp_extract(column, re.escape(base_path) + r"/(.+)$", 1)


def zone_usage(inventory: DataFrame, base: str) -> DataFrame:
    """``zone, files, bytes`` per first-level folder below ``base``."""
    zone = F.regexp_extract(_below("path", base), r"^([^/]+)/", 1)
    return inventory.groupBy(zone.alias("zone")).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
    )


def zone_status(spark: SparkSession, base: str, zones: Sequence[str]) -> DataFrame:
    """``zone, status, files, bytes, rows``: what has landed in each of ``zones`` below ``base``.

    ``status`` is ``present``, ``empty`` (a folder without a line) or ``absent`` (no
    such path). Files come from the listing, ``rows`` (lines) from reading them; both
    are joined per file, so a file that is listed but cannot be read shows up
    with 0 rows. A path that does not exist is a zone that is absent.
    """
    wanted = spark.createDataFrame([(z,) for z in zones], "zone string")
    found = []
    for zone in zones:  # a zone that is missing altogether must not fail the others
        path = f"{base.rstrip('/')}/{zone}"
        try:
            listed = file_inventory(spark, path)
            lines = spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("_metadata.file_path").alias("_file"))
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc.getCondition()):
                raise
            continue
        tail = listed.select(_below("path", path).alias("_tail"), "length")
        rows = lines.groupBy(_below("_file", path).alias("_row_tail")).agg(F.count("*").alias("n"))
        joined = tail.join(rows, F.col("_tail") == F.col("_row_tail"), "left")
        found.append(
            joined.agg(
                F.count("*").alias("files"),
                F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            ).select(F.lit(zone).alias("zone"), "files", "bytes", "rows")
        )
    none = wanted.select("zone", *[F.lit(0).cast("long").alias(c) for c in ("files", "bytes", "rows")]).limit(0)
    all_found = functools.reduce(DataFrame.unionByName, found, none)
    status = F.when(F.col("files").isNull(), "absent").when(F.col("rows") == 0, "empty").otherwise("present")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("files", "bytes", "rows")]
    return wanted.join(all_found, "zone", "left").select("zone", status.alias("status"), *counts)
