"""Column-level building blocks shared by the analyses.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A request is an error from this status code up (client and server errors).
ERROR_FROM = 400


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_error(status: str | Column = "status_code", error_from: int = ERROR_FROM) -> Column:
    """``status >= error_from``; NULL status is never an error."""
    return _col(status) >= error_from


def error_flag_count(status: str | Column = "status_code", error_from: int = ERROR_FROM) -> Column:
    """Number of error rows in a group (0, never NULL, on empty groups)."""
    return F.count_if(is_error(status, error_from))


def with_time_columns(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add ``date``, ``hour`` and ``day_of_week`` (1 = Sunday … 7 = Saturday).

    ``ts`` must be a typed ``TIMESTAMP_NTZ`` (UTC wall clock), so the parts do
    not move with the session time zone. A ``date`` column that is already
    present (e.g. a partition column) is replaced; filter on it first so
    partition pruning still applies.
    """
    t = F.col(ts)
    return df.withColumns({"date": F.to_date(t), "hour": F.hour(t), "day_of_week": F.dayofweek(t)})


def percent(part: str | Column, whole: str | Column, scale: int = 2) -> Column:
    """``ROUND(part * 100 / whole, scale)`` as DOUBLE, in exact decimal arithmetic.

    Rounding happens on the exact decimal quotient (half up), not on a binary
    double, so a share such as 1.005 % always becomes 1.01 %. A zero or NULL
    ``whole`` gives NULL instead of raising under ANSI mode.
    """
    num = _col(part).cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)")
    quotient = F.try_divide(num, _col(whole).cast("decimal(20,0)"))
    return F.round(quotient, scale).cast("double")


def mean_of(total: Column, count: Column) -> Column:
    """The mean from a BIGINT sum and a count (NULL without values), as ``AVG`` gives it."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def scalar_total(grouped: DataFrame, measure: str) -> Column:
    """``(SELECT SUM(measure) FROM grouped)`` as a scalar-subquery column.

    Taken over an already grouped frame, the subquery shares the grouped
    aggregate's shuffle (exchange reuse), so a share-of-total costs one scan of
    the input and no single-partition window.
    """
    return grouped.agg(F.sum(measure)).scalar()


def scalar_max(grouped: DataFrame, measure: str) -> Column:
    """``(SELECT MAX(measure) FROM grouped)`` as a scalar-subquery column."""
    return grouped.agg(F.max(measure)).scalar()
