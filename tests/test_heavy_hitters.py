"""Top-k by sketch against the exact analyses, on skewed, flat and tied keys."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loglens import operators as ops
from loglens.operators import heavy_hitters as hh
from tests.test_io import same_rows

SCHEMA = "endpoint string, ip_address string, user_id string, session_id string, response_time long, timestamp timestamp_ntz"


def some_logs(spark, seed: int, weights: list[int], others: int):
    """Keys 0, 1, ... with the given numbers of rows, and ``others`` keys with a row each."""
    r = random.Random(seed)
    keys = [k for k, w in enumerate(weights) for _ in range(w)] + [10_000 + k for k in range(others)]
    r.shuffle(keys)
    rows = []
    for i, k in enumerate(keys):
        name = None if k == 3 else f"k{k}"
        rows.append((name, name, name, None if i % 11 == 0 else f"s{k % 5}", i % 90, None))
    return spark.createDataFrame(rows, SCHEMA).withColumn("timestamp", F.expr("timestamp_ntz '2024-01-01 00:00:00'")).repartition(6)


CASES = {
    "skewed": ([900, 700, 650, 640, 600, 500, 400, 300] + [90] * 40, 3000),
    "tied at the cut": ([500] * 12 + [40] * 60, 2000),
    "flat": ([3] * 900, 1500),
    "few": ([50, 20, 20, 20, 20, 20, 9], 0),
}


@pytest.mark.parametrize("name", sorted(CASES))
@pytest.mark.parametrize("tracked", [300, 16_384])
def test_heavy_reports_equal_the_exact_ones(spark, name, tracked):
    logs = some_logs(spark, 1, *CASES[name])
    for heavy, exact, k in [
        (hh.heavy_top_endpoints, ops.top_endpoints, 10),
        (hh.heavy_ip_frequency, ops.ip_frequency, 5),
        (hh.heavy_user_activity, ops.user_activity, 15),
        (hh.heavy_session_patterns, ops.session_patterns, 10),
    ]:
        assert [tuple(r) for r in heavy(logs, k, tracked).collect()] == [tuple(r) for r in exact(logs, k).collect()]


@pytest.mark.parametrize("seed", range(4))
def test_the_bound_holds(spark, seed):
    """No listed key's estimate is off by more than the error, and the candidates hold the top k with ties."""
    r = random.Random(seed)
    weights = [r.randint(1, r.choice([5, 60, 900])) for _ in range(r.randint(20, 400))]
    logs = some_logs(spark, seed, weights, r.randint(0, 3000))
    counts = Counter(row["endpoint"] for row in logs.select("endpoint").collect())
    for tracked in (64, 500, 5000):
        found = hh.find_candidates(logs, ["endpoint"], 7, tracked)
        assert found.rows == sum(counts.values())
        if found.keys is not None:
            least = sorted(counts.values(), reverse=True)[min(7, len(counts)) - 1]
            assert {k for k, n in counts.items() if n >= least} <= set(found.keys)
            assert found.error == 0 or len(found.keys) < tracked / 3


def test_skew_separates_and_flat_keys_do_not(spark):
    skewed = some_logs(spark, 2, [5000, 4000, 3000, 2500, 2000, 5], 4000)
    found = hh.find_candidates(skewed, ["endpoint"], 4, 1000)
    assert found.error > 0 and set(found.keys) >= {"k0", "k1", "k2", None} and len(found.keys) < 10
    assert hh.find_candidates(some_logs(spark, 2, [2] * 3000, 0), ["endpoint"], 4, 100).keys is None


def test_no_shuffle_of_all_keys(spark):
    """The exact step finds the candidates' rows in the scan and groups only those."""
    logs = some_logs(spark, 3, [5000, 4000, 3000, 2500, 2000, 1500, 1400, 1300, 1200, 1100, 1000], 6000)
    result = hh.heavy_top_endpoints(logs, 10, 2000)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    grouped = hh.candidate_rows(logs, ["endpoint"], 10, 2000)
    assert grouped.select("endpoint").distinct().count() < 30 < logs.select("endpoint").distinct().count()
    sketch = logs.select(F.expr("approx_top_k_accumulate(endpoint, 100)").alias("s"))
    assert "hashpartitioning(endpoint" not in sketch._jdf.queryExecution().executedPlan().toString()


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hh.heavy_top_endpoints(empty).collect() == [] and hh.heavy_user_activity(empty).collect() == []


def test_on_the_log_view(spark, logs):
    assert same_rows(hh.heavy_user_activity(logs), ops.user_activity(logs))
    assert hh.heavy_user_activity.__name__ == "heavy_user_activity"
