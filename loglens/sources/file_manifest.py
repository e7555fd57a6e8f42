"""A kept list of files: what is stored, known without listing it again.

Listing a large tree goes through the driver and asks the store for every directory, for
every question. A :class:`FileManifest` keeps the entries as a table instead: a write adds the files of
its own folder, and usage and verification read the table, distributed like any other. Listing the tree is
left as the check of the manifest: :meth:`FileManifest.differences` compares the two, and
:meth:`FileManifest.sync` takes the differences over.

The table is a log (an entry per change of a file; the latest counts), and every
change is one committed version (:mod:`loglens.sinks.manifest`).
"""

from __future__ import annotations

import uuid
from typing import Any
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.manifest import commit_version, latest_version
from .results import file_inventory

ENTRY = "file string, length long, modified timestamp, number long, gone boolean"


def _relative(path: str, base: str) -> Column:
    """The path column below ``base``."""
    root = (urlparse(base).path if "://" in base or base.startswith("file:") else base).rstrip("/") + "/"
    at = F.locate(root, F.col(path))
    return F.when(at > 0, F.substring(F.col(path), at + len(root), F.length(path)))


def listed(spark: SparkSession, base: str, folder: str | None = None) -> DataFrame:
    """``file, length, modified`` of the files below ``base`` (or one ``folder`` of it), by listing them."""
    below = f"{base.rstrip('/')}/{folder}" if folder else base
    rows = file_inventory(spark, below)
    return rows.select(_relative("path", base).alias("file"), "length", F.col("modificationTime").alias("modified"))


class FileManifest:
    """The files below ``base`` as of the manifest's last version; the table is kept at ``path`` (outside ``base``)."""

    def __init__(self, spark: SparkSession, path: str, base: str):
        self.spark, self.path, self.base = spark, path.rstrip("/"), base.rstrip("/")

    def _version(self) -> dict[str, Any]:
        return latest_version(self.spark, self.path) or {"number": 0, "entries": []}

    def log(self) -> DataFrame:
        """All entries so far."""
        schema, folders = T.StructType.fromDDL(ENTRY), self._version()["entries"]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def files(self) -> DataFrame:
        """``file, length, modified`` of all files, from the manifest."""
        value = F.struct("length", "modified", "gone")
        latest = self.log().groupBy("file").agg(F.max_by(value, "number").alias("v"))
        return latest.filter(~F.col("v.gone")).select("file", "v.length", "v.modified")

    def usage(self) -> DataFrame:
        """``zone, files, bytes`` per first folder below ``base``, from the manifest."""
        zone = F.substring_index("file", "/", 1).alias("zone")
        return self.files().groupBy(zone).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))

    def differences(self, listing: DataFrame | None = None, folder: str | None = None) -> DataFrame:
        """``file, status, length, modified``: files that the listing has and the manifest lacks (``added``),
        has otherwise (``changed``) or does not have any more (``gone``); the values are the listing's."""
        listing = listed(self.spark, self.base, folder) if listing is None else listing
        held = self.files().filter(F.col("file").startswith(f"{folder.rstrip('/')}/")) if folder else self.files()
        held = held.select("file", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
        both = listing.join(held, "file", "full")
        changed = (F.col("length") != F.col("_length")) | (F.col("modified") != F.col("_modified"))
        status = F.when(F.col("_length").isNull(), "added").when(F.col("length").isNull(), "gone").when(changed, "changed")
        return both.select("file", status.alias("status"), "length", "modified").filter(F.col("status").isNotNull())

    def sync(self, folder: str | None = None) -> int:
        """Take over the differences between the tree (or one ``folder``, such as a write's) and the manifest.

        Returns the number of entries written; without any there is no new version.
        """
        version = self._version()
        number = version["number"] + 1
        entries = self.differences(folder=folder).select(
            "file", "length", "modified", F.lit(number).cast("long").alias("number"), (F.col("status") == "gone").alias("gone")
        )
        place = f"{self.path}/entries/{number:012d}-{uuid.uuid4().hex[:8]}"
        entries.write.parquet(place)
        n = self.spark.read.schema(T.StructType.fromDDL(ENTRY)).parquet(place).count()
        if n:
            commit_version(self.spark, self.path, number, {"entries": [*version["entries"], place]})
        return n
