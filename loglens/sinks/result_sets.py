"""Sets of results that readers see whole or not at all.

Every result of a set is staged in a folder of its own; when all are there, one version
(:mod:`.manifest`) is committed that names them with their columns. Readers follow the last version,
so a set that fails half-way, or whose writer is killed, leaves them on the former one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sources.results import read_result_csv
from .landing import SaveError, root_cause, save_result_csv
from .manifest import commit_version, latest_version, read_version

# How a NULL is written, so that it stays apart from an empty text.
NULL = "\\N"


def save_result_set(
    spark: SparkSession,
    results: Mapping[str, DataFrame],
    base: str,
    single_file: Collection[str] = (),
    orders: Mapping[str, Sequence[Column]] | None = None,
) -> int:
    """Save all ``results`` as CSV under ``base`` and make them its current set; returns the set's version.

    All are tried. If any fails, nothing is committed and :class:`~.landing.SaveError` names each with its cause.
    """
    now = latest_version(spark, base)
    number = now["number"] + 1 if now else 1
    staged = f"{base.rstrip('/')}/sets/{number:012d}-{uuid.uuid4().hex[:8]}"
    status, entries = {}, {}
    for name, frame in results.items():
        try:
            path = f"{staged}/{name}"
            save_result_csv(frame, path, name in single_file, NULL, (orders or {}).get(name, ()))
            entries[name] = {"path": path, "schema": frame.schema.json()}
            status[name] = "ok"
        except Exception as exc:  # every result's outcome is reported
            status[name] = f"failed: {root_cause(exc)}"
    if len(entries) < len(status):
        raise SaveError(status)
    commit_version(spark, base, number, {"results": entries})
    return number


def read_result_set(spark: SparkSession, base: str, number: int | None = None) -> dict[str, DataFrame]:
    """The results of the current set under ``base`` (or of version ``number``), typed; none before the first."""
    version = latest_version(spark, base) if number is None else read_version(spark, base, number)
    entries = version["results"] if version else {}
    return {
        name: read_result_csv(spark, e["path"], StructType.fromJson(json.loads(e["schema"])), NULL) for name, e in entries.items()
    }
