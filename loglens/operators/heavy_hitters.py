"""Top-k reports that never shuffle all keys: heavy hitters by a mergeable sketch.

A top-k needs exact counts of the k largest groups only. A frequent-items sketch (a
fixed number of counters per task, merged in a tree) gives an upper estimate of every
frequent key's count that is at most ``E`` too high, with ``E = 3.5 * rows / counters``. So

* the k-th largest count is at least ``T = (k-th largest estimate) - E``;
* a key that the sketch does not list has at most ``2 * E`` rows.

If ``T > 2 * E`` the *candidates*, the listed keys whose estimate is at least ``T``, hold
every key of the top k and all keys tied with the k-th: there are at most
``rows / (T - E)`` of them, fewer than ``counters / 3``, so they are broadcast, and the exact analysis runs
over their rows alone. Their rows are found in the scan; nothing else is shuffled. Estimates that add up
to the number of rows are all exact, which also separates (few different keys). Where the bound
does not separate rank k (nearly equal groups), the exact analysis runs over all rows, as without a sketch.

The sketch is one job over the key columns when the function is called; the result is lazy.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .distribution import ip_frequency, top_endpoints
from .users import session_patterns, user_activity

# Keys that a sketch follows. The bound is 3.5 / TRACKED of all rows.
TRACKED = 16_384
# Frequent-items sketches with a map of M counters err by at most this / M of all rows.
ERROR_FACTOR = 3.5

_KEY = "_heavy_key"


@dataclass(frozen=True)
class Candidates:
    """What a sketch says about the top k: the keys that can be in it, or ``None`` if it can't tell."""

    rows: int
    error: int
    threshold: int
    keys: list[str | None] | None


def _text_key(rows: DataFrame, keys: Sequence[str]) -> Column:
    """One text per different key (NULL for a single NULL key)."""
    if len(keys) == 1 and rows.schema[keys[0]].dataType.simpleString() == "string":
        return F.col(keys[0])
    return F.to_json(F.struct(*keys))


def find_candidates(rows: DataFrame, keys: Sequence[str], k: int, tracked: int = TRACKED) -> Candidates:
    """The keys that can be among the ``k`` most frequent ones, or tied with the last of them.

    Each task fills one sketch; they are merged in two steps, so that no task reads those of all others.
    """
    parts = max(1, math.isqrt(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    keyed = rows.select(_text_key(rows, keys).alias(_KEY), F.pmod(F.spark_partition_id(), F.lit(parts)).alias("part"))
    merged = keyed.groupBy("part").agg(F.expr(f"approx_top_k_accumulate({_KEY}, {tracked})").alias("sketch"), F.count("*").alias("n"))
    # one group, or none without rows (an empty sketch can't be read)
    merged = merged.groupBy(F.lit(1)).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("n").alias("n"))
    row = merged.select("n", F.expr(f"approx_top_k_estimate(sketch, {tracked})").alias("items")).first()  # one row
    if row is None:
        return Candidates(0, 0, 0, [])
    n = row["n"]
    error = math.ceil(ERROR_FACTOR * n / tracked)
    found = sorted(((item["count"], item["item"]) for item in row["items"]), key=lambda x: -x[0])
    exact = sum(c for c, _ in found) == n  # upper estimates of all keys
    if exact:
        error = 0
    if len(found) <= k:
        return Candidates(n, error, 0, [key for _, key in found] if exact else None)
    threshold = found[k - 1][0] - error
    if not exact and threshold <= 2 * error:
        return Candidates(n, error, threshold, None)
    return Candidates(n, error, threshold, [key for c, key in found if c >= threshold])


def candidate_rows(rows: DataFrame, keys: Sequence[str], k: int, tracked: int = TRACKED) -> DataFrame:
    """The rows of ``rows`` whose ``keys`` can be among the ``k`` most frequent ones; all rows if the sketch can't tell."""
    found = find_candidates(rows, keys, k, tracked)
    if found.keys is None:
        return rows
    wanted = rows.sparkSession.createDataFrame([(key,) for key in found.keys], f"{_KEY} string")
    return rows.join(F.broadcast(wanted), _text_key(rows, keys).eqNullSafe(F.col(_KEY)), "left_semi")


def _heavy(analysis: Callable[..., DataFrame], keys: Sequence[str], not_null: str | None, k: int, logs: DataFrame, tracked: int) -> DataFrame:
    rows = logs.filter(F.col(not_null).isNotNull()) if not_null else logs
    return analysis(candidate_rows(rows, keys, k, tracked), k)


def _report(analysis: Callable[..., DataFrame], keys: Sequence[str], not_null: str | None, k: int) -> Callable[..., DataFrame]:
    @functools.wraps(analysis)
    def run(logs: DataFrame, k: int = k, tracked: int = TRACKED) -> DataFrame:
        return _heavy(analysis, keys, not_null, k, logs, tracked)

    run.__name__ = f"heavy_{analysis.__name__}"
    run.__doc__ = f"The result of ``{analysis.__name__}``, from the rows of the sketch's candidates where it separates rank ``k``."
    return run


# The same rows as the analyses they are named after, ties included.
heavy_top_endpoints = _report(top_endpoints, ["endpoint"], None, 10)
heavy_ip_frequency = _report(ip_frequency, ["ip_address"], None, 5)
heavy_user_activity = _report(user_activity, ["user_id"], "user_id", 15)
heavy_session_patterns = _report(session_patterns, ["session_id", "user_id"], "session_id", 10)
