"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import fresh_path, session_key

# A word: a maximal run of characters other than ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per application), for
    clusters on which it is not installed."""
    if session_key(spark) not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        name = __name__.split(".")[0]
        spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), name), "zip", root, name))
        _shipped.add(session_key(spark))


def whole_row(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that names made here cannot clash with theirs (``select("row.*")`` undoes it)."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns)).alias(name)


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of ``df``; it orders rows alike in their keys in the same way on every run."""
    columns = []
    for f in df.schema.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`")
        # Spark hashes no maps
        columns.append(F.to_json(F.struct(c)) if "map<" in f.dataType.simpleString() else c)
    return F.xxhash64(*columns)


# What a worker process keeps for its next tasks (see worker_cache), and the module that these were of.
_caches: list[dict] = []
_last_module: list[str] = []


def worker_cache() -> dict:
    """A dict that lives in a worker process as long as its tasks are of one module's functions."""
    _caches.append({})
    return _caches[-1]


def give_back() -> None:
    """Return freed memory to the system (glibc keeps it for the process otherwise)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _tidy_task(function: Callable, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``function(batches)`` in a worker process that lives on beside the executor's JVM: what the tasks of
    another module kept is dropped first, and what the task itself has freed leaves the process at its end."""
    module = getattr(function.func if isinstance(function, functools.partial) else function, "__module__", "")
    if _last_module != [module]:
        for cache in _caches:
            cache.clear()
        _last_module[:] = [module]
    try:
        yield from function(batches)
    finally:
        give_back()


def map_arrow(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers, which give a task's memory back at its end."""
    ship(df.sparkSession)
    return df.mapInArrow(functools.partial(_tidy_task, function), schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the session's shared folder and return a scan of it.

    The written table survives lost executors and cuts the lineage; later
    steps read only the columns they use.
    """
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def count_words(text: str | Column) -> Column:
    """Number of words in ``text`` (0 for NULL)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: str | Column) -> Column:
    """``text`` with A-Z (and nothing else) in lower case."""
    return F.translate(F.col(text) if isinstance(text, str) else text, UPPER, UPPER.lower())


def group_key(column: str) -> Column:
    """A non-null join key for a nullable string column (NULL is a group of its own)."""
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(column).cast("string")))
