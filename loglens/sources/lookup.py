"""Log tables for finding the rows of one user, session or address.

The rows are packed by date and sorted by user inside a file, so a row group spans few users and its
minimum and maximum rule out the others. Sessions and addresses are spread over such a file; their
Bloom filters, written per row group, rule out nearly all row groups that do not hold the wanted
one. Both are checked from the file's footer before any data is read; only the row groups left are decoded.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sinks.packing import FILE_BYTES
from .log_table import read_log_table, store_logs

LOOKUP_KEYS = ("user_id", "session_id", "ip_address")
ROW_GROUP_BYTES = 16 << 20
# Different values of a key in a row group that its Bloom filter is sized for (about 1.2 bytes each at 1 % false hits).
EXPECTED_VALUES = 200_000


def lookup_options(
    keys: Sequence[str] = LOOKUP_KEYS, expected: int = EXPECTED_VALUES, row_group_bytes: int = ROW_GROUP_BYTES, false_hits: float = 0.01
) -> dict[str, str]:
    """Parquet writer options: Bloom filters on ``keys``, row groups of ``row_group_bytes``."""
    options = {"parquet.block.size": str(row_group_bytes)}
    for key in keys:
        options[f"parquet.bloom.filter.enabled#{key}"] = "true"
        options[f"parquet.bloom.filter.expected.ndv#{key}"] = str(expected)
        options[f"parquet.bloom.filter.fpp#{key}"] = str(false_hits)
    return options


def store_lookup_logs(
    spark: SparkSession,
    logs: DataFrame,
    keys: Sequence[str] = LOOKUP_KEYS,
    file_bytes: int = FILE_BYTES,
    row_group_bytes: int = ROW_GROUP_BYTES,
    expected: int = EXPECTED_VALUES,
    path: str | None = None,
) -> str:
    """Write ``logs`` for look-ups by ``keys`` (clustered by the first) and return the path."""
    options = lookup_options(keys, expected, row_group_bytes)
    return store_logs(spark, logs, file_bytes=file_bytes, sort_by=[keys[0], "timestamp"], path=path, options=options)


def find_logs(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    dates: Iterable[str | dt.date] | None = None,
    **wanted: str | Sequence[str],
) -> DataFrame:
    """The rows stored under ``path`` whose columns have the ``wanted`` values (one, or any of several).

    ``find_logs(spark, path, session_id="sess_7_20240115")``. The conditions reach the scan as
    plain equalities, so days, row groups and pages are skipped before decoding.
    """
    rows = read_log_table(spark, path, dates, schema)
    for column, value in wanted.items():
        rows = rows.filter(F.col(column) == value if isinstance(value, str) else F.col(column).isin(list(value)))
    return rows
