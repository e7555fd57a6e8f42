"""Deterministic ordering and top-k.

Every ranking orders by its measure(s) and then by the grouping keys, so rows
tied at the cut are chosen the same way on every run and by the SQL oracle
(``ORDER BY m DESC, key ASC NULLS FIRST``).

``orderBy(...).limit(k)`` is planned as ``TakeOrderedAndProject``: each task
keeps its own k best rows and only k rows per task reach the final merge, so a
top-k never shuffles or sorts the whole input.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def ordering(desc: Sequence[str] = (), asc: Sequence[str] = ()) -> list[Column]:
    """Sort columns: ``desc`` measures first, then ``asc`` tie-breakers (NULLs first)."""
    return [F.col(c).desc_nulls_last() for c in desc] + [F.col(c).asc_nulls_first() for c in asc]


def top_k(df: DataFrame, k: int, desc: Sequence[str] = (), asc: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows of ``df`` by ``desc`` measures, ties by ``asc`` keys."""
    return df.orderBy(*ordering(desc, asc)).limit(k)


def sort_rows(df: DataFrame, desc: Sequence[str] = (), asc: Sequence[str] = ()) -> DataFrame:
    """Full deterministic sort (for bounded, already aggregated results)."""
    return df.orderBy(*ordering(desc, asc))


def rows_of_top(rows: DataFrame, top: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of ``rows`` whose ``keys`` are among the top-k rows ``top``,
    with ``top``'s other columns attached.

    ``top`` holds at most k rows. Spark knows that size from the limit and
    broadcasts them below its threshold, which filters ``rows`` inside the scan
    stage; a larger k is joined by shuffle. Keys match NULL-safely (a NULL key is
    a group of its own).
    """
    renamed = {k: f"_top_{k}" for k in keys}
    t = top.select(*[F.col(c).alias(renamed.get(c, c)) for c in top.columns])
    cond = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(renamed[k])) for k in keys])
    return rows.join(t, cond, "inner").drop(*renamed.values())
