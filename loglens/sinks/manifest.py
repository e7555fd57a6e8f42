"""Versions of a folder: data is staged in new places and counts once its version is committed.

A version is one line of JSON under ``<base>/versions/<number>/``, written after everything it
names. Spark's file commit makes the line visible whole or not at all, so a reader sees the last
whole version however a writer ends, and files of a failed one are never named. Two
writers that start from one version can't both commit the next: the second finds the folder taken.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def _folder(base: str, number: int) -> str:
    return f"{base.rstrip('/')}/versions/{number:012d}"


def commit_version(spark: SparkSession, base: str, number: int, content: dict[str, Any]) -> None:
    """Make ``content`` version ``number`` (1, 2, ...) of ``base``; fails if there is one already."""
    row: DataFrame = spark.createDataFrame([(json.dumps({**content, "number": number}),)], "value string")
    row.coalesce(1).write.mode("errorifexists").text(_folder(base, number))


def latest_version(spark: SparkSession, base: str) -> dict[str, Any] | None:
    """The last committed version of ``base``, ``None`` before the first."""
    try:
        lines = spark.read.option("recursiveFileLookup", True).text(f"{base.rstrip('/')}/versions")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = lines.selectExpr("max_by(value, cast(get_json_object(value, '$.number') AS long)) AS value").first()
    return json.loads(row["value"]) if row["value"] else None


def read_version(spark: SparkSession, base: str, number: int) -> dict[str, Any]:
    """Version ``number`` of ``base``."""
    return json.loads(spark.read.text(_folder(base, number)).first()["value"])
