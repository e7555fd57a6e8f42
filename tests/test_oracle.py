"""Every registered query of the library against its SQL oracle (DuckDB) on sf0.001."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from loglens.plans.catalog import all_queries
from loglens.plans.oracle import oracle_queries
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare

ORACLE = oracle_queries()
QUERIES = all_queries()
# statements that end in an ORDER BY of the whole result: the order counts too
SORTED = {k for k, sql in ORACLE.items() if re.search(r"ORDER BY [^()]*$", sql)}


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())
    assert {"hourly_traffic", "user_activity", "level_distribution", "sql_logs_time"} <= SORTED


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    ok, msg = compare(QUERIES[key](spark, SF_SMALL), duck, ORACLE[key], exact=True, ordered=key in SORTED)
    assert ok, f"{key}: {msg}"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["server", "total_requests", "avg_response_ms", "max_response_ms"]
    assert df.count() > 0
