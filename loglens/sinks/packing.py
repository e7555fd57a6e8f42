"""Files of a chosen size: rows dealt by key with sizes known at run time.

A partitioned write leaves a file per task and directory. Tasks that hold rows of
all days then write tasks x days small files, and a scan pays for every one of them.
Dealing the rows by day alone gives one task a whole busy day. ``REBALANCE`` leaves
the choice to adaptive execution, which knows the bytes of every day after the shuffle's map
side: small days are put together into one task, a day of more than a task's
share is split over several. So a directory gets about one file per ``file_bytes``,
whatever the input's size, order or skew, and no number has to be given beforehand.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

FILE_BYTES = 128 << 20
# Shuffled bytes (rows, compressed) per byte of the file written from them. Columnar
# files are smaller than their rows; JSON Lines repeat the field names and are larger.
SHUFFLED_PER_BYTE = {"parquet": 2.0, "json": 0.3}


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings of ``spark`` for the jobs started inside; the former ones come back after it."""
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def pack_conf(file_bytes: int = FILE_BYTES, format: str = "parquet") -> dict[str, str]:
    """Settings under which :func:`rebalanced` rows give files of about ``file_bytes``."""
    share = max(1, int(file_bytes * SHUFFLED_PER_BYTE.get(format, 1.0)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(share),
        # a rest of less than half a share joins its neighbour
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.5",
    }


def rebalanced(df: DataFrame, by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """``df`` dealt by ``by`` with sizes decided at run time, each task's rows sorted by ``by`` and ``sort_by``.

    ``sort_by`` clusters the rows inside a file, so that row groups have narrow ranges of these columns.
    """
    return df.hint("rebalance", *by).sortWithinPartitions(*by, *sort_by)


def write_packed(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    file_bytes: int = FILE_BYTES,
    sort_by: Sequence[str] = (),
    format: str = "parquet",
    mode: str = "errorifexists",
    options: Mapping[str, str] | None = None,
) -> str:
    """Write ``df`` under ``path`` in directories by ``by``, in files of about ``file_bytes``; returns the path."""
    with session_conf(df.sparkSession, pack_conf(file_bytes, format)):
        writer = rebalanced(df, by, sort_by).write.mode(mode).options(**(options or {})).partitionBy(*by)
        writer.format(format).save(path)
    return path
