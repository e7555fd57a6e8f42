"""Groups kept per day against the report over the rows, and sets of results."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loglens import operators as ops
from loglens.functions.numbering import number_rows
from loglens.plans import daily_state
from loglens.plans.daily_state import DailyState
from loglens.plans.one_scan import analyze_one_by_one
from loglens.plans.report import RESULT_KEYS, long_form
from loglens.schema import LOG_SCHEMA
from loglens.session import fresh_path
from loglens.sinks.landing import SaveError
from loglens.sinks.manifest import commit_version, latest_version
from loglens.sinks.result_sets import read_result_set, save_result_set


def random_logs(spark, seed: int, n: int, days: int = 6):
    """Few different values, NULLs in every column, some rows without a timestamp."""
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        pick = lambda values: None if r.random() < 0.07 else r.choice(values)
        when = None if r.random() < 0.03 else dt.datetime(2024, 3, 1 + r.randrange(days), r.randrange(24), r.randrange(60))
        rows.append((
            when, pick(["INFO", "ERROR"]), pick(["a", "b", "c"]), "app", pick([f"ip{k}" for k in range(9)]), pick(["GET", "PUT"]),
            pick([f"/e{k}" for k in range(12)]), pick([200, 404, 500]), pick(list(range(5, 500, 7))), pick([f"u{k}" for k in range(20)]),
            pick([f"s{k}" for k in range(30)]), 1, "agent",
        ))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def shown(frame):
    return [tuple(r) for r in frame.orderBy(*frame.columns).collect()]


def check_results(state, logs, days=None, names=None):
    got, want = state.results(days), analyze_one_by_one(logs)
    assert set(got) == set(want)
    for name in names or want:
        assert got[name].columns == want[name].columns
        assert shown(got[name]) == shown(want[name]), name


def test_refreshed_days_give_the_whole_report(spark):
    old, late, again = (random_logs(spark, s, 300, d) for s, d in ((1, 4), (2, 6), (3, 2)))
    path = fresh_path(spark, "state")
    first_days = old.filter("day(timestamp) <= 3 OR timestamp IS NULL")
    state = DailyState.open(spark, path).refresh(first_days)
    state = state.refresh(late.filter("day(timestamp) > 3"))
    whole = first_days.unionByName(late.filter("day(timestamp) > 3"))
    check_results(DailyState.open(spark, path), whole)
    # a day lands again: only that day changes
    before = dict(state.version["days"])
    state = state.refresh(again, days=[dt.date(2024, 3, 2)])
    assert {d for d, held in state.version["days"].items() if held != before.get(d)} == {"2024-03-02"}
    whole = whole.filter("day(timestamp) <> 2 OR timestamp IS NULL").unionByName(again.filter("day(timestamp) = 2"))
    check_results(state, whole)
    # a range of days, and a day that lands empty
    some = ["2024-03-02", "2024-03-03", dt.date(2024, 3, 5)]
    check_results(state, whole.filter("day(timestamp) IN (2, 3, 5)"), some, ["kpi_summary", "pattern_statistics", "server_activity", "user_activity", "session_patterns", "distinct_endpoints", "hourly_traffic"])
    state = state.refresh(again.limit(0), days=["2024-03-04"])
    assert "2024-03-04" in state.days()
    check_results(state, whole.filter("day(timestamp) <> 4 OR timestamp IS NULL"), names=["level_distribution", "unique_endpoints", "session_patterns"])


def test_refresh_reads_only_the_given_days(spark, monkeypatch):
    logs = random_logs(spark, 4, 200)
    state = DailyState.open(spark, fresh_path(spark, "state")).refresh(logs)
    counted = []
    real = daily_state.daily_base
    monkeypatch.setattr(daily_state, "daily_base", lambda rows, e: counted.append(rows.count()) or real(rows, e))
    state.refresh(logs, days=["2024-03-02"])
    assert counted == [logs.filter("day(timestamp) = 2").count()]


def test_a_failed_refresh_leaves_the_last_version(spark, monkeypatch):
    logs = random_logs(spark, 5, 150)
    path = fresh_path(spark, "state")
    state = DailyState.open(spark, path).refresh(logs)
    want = shown(state.results()["kpi_summary"])

    def broken(rows):
        return rows.select(F.raise_error(F.lit("disk full")).alias("session_id"))

    monkeypatch.setattr(daily_state, "daily_pages", broken)
    with pytest.raises(Exception):
        state.refresh(random_logs(spark, 6, 80))
    monkeypatch.undo()
    now = DailyState.open(spark, path)
    assert now.version == state.version and shown(now.results()["kpi_summary"]) == want
    # its leftovers don't get in the way of the next refresh
    other = random_logs(spark, 7, 90)
    assert shown(now.refresh(other).results()["simple_count"]) == shown(ops.simple_count(other.unionByName(logs.join(other.select(daily_state.day_of().alias("x")).distinct(), daily_state.day_of() == F.col("x"), "left_anti"))))
    assert shown(DailyState.open(spark, path, 1).results()["kpi_summary"]) == want


def test_distinct_counts_from_bitmaps_alone(spark):
    logs = random_logs(spark, 8, 400)
    state = DailyState.open(spark, fresh_path(spark, "state")).refresh(logs)
    counts = state.distinct_counts(["2024-03-01", "2024-03-04"])
    read = {f.split("/daily-state")[-1] for f in counts.inputFiles()}
    assert read and all("/bitmaps/day=2024-03-0" in f and ("=2024-03-01" in f or "=2024-03-04" in f) for f in read)
    got = {(r["metric"], r["key"]): (r["count"], r["has_null"]) for r in counts.collect()}
    rows = logs.filter("day(timestamp) IN (1, 4)")
    want = rows.agg(F.count_distinct("endpoint").alias("n"), F.max(F.col("endpoint").isNull()).alias("x")).first()
    assert got[("endpoints", None)] == (want["n"], want["x"])
    for r in rows.filter("server IS NOT NULL").groupBy("server").agg(F.count_distinct("method").alias("n")).collect():
        assert got[("server_methods", r["server"])][0] == r["n"]
    ids = state.dictionary().groupBy("domain").agg(F.count("*").alias("n"), F.max("id").alias("last"), F.count_distinct("id").alias("ids"))
    assert all(r["n"] == r["last"] == r["ids"] for r in ids.collect())


def test_many_values_fill_several_buckets(spark):
    logs = random_logs(spark, 9, 10).limit(1).crossJoin(spark.range(70_000)).withColumn("endpoint", F.concat(F.lit("/p"), "id")).drop("id")
    logs = logs.withColumns({"timestamp": F.expr("timestamp_ntz '2024-03-01 01:00:00'"), "method": F.lit("GET"), "server": F.lit("s")})
    state = DailyState.open(spark, fresh_path(spark, "state")).refresh(logs)
    more = logs.withColumns({"endpoint": F.concat("endpoint", F.lit("x")), "timestamp": F.expr("timestamp_ntz '2024-03-02 01:00:00'")}).limit(5000)
    state = state.refresh(more)
    assert state.table("bitmaps").filter("metric = 'endpoints'").count() >= 4
    assert state.distinct_counts().filter("metric = 'endpoints'").first()["count"] == 75_000


def test_empty_state_and_empty_logs(spark):
    path = fresh_path(spark, "state")
    empty = spark.createDataFrame([], LOG_SCHEMA)
    state = DailyState.open(spark, path)
    assert state.days() == []
    for s in (state, state.refresh(empty)):
        check_results(s, empty, names=["simple_count", "kpi_summary", "null_counts", "pattern_statistics", "user_activity", "top_endpoints"])


def test_numbers_are_dense_and_in_order(spark):
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(500).select((F.col("id") * 37 % 500).alias("v")).repartition(7)
        got = sorted((r["number"], r["v"]) for r in number_rows(spark, df, [F.col("v").desc()], start=10).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == [(10 + k, 499 - k) for k in range(500)]
    assert number_rows(spark, df.limit(0), [F.col("v")]).count() == 0


def test_readers_see_a_whole_set_or_the_former_one(spark):
    base = fresh_path(spark, "sets")
    assert read_result_set(spark, base) == {}
    one = {"a": spark.createDataFrame([(1, None), (2, ""), (3, "x,\n\"y\"")], "n long, t string"), "b": spark.range(3).toDF("n")}
    assert save_result_set(spark, one, base, single_file=["a"], orders={"a": [F.col("n")]}) == 1
    two = {"a": spark.createDataFrame([(9, "new")], "n long, t string"), "b": spark.range(2).select(F.raise_error(F.lit("broken")).cast("long").alias("n"))}
    with pytest.raises(SaveError, match="broken"):
        save_result_set(spark, two, base)
    got = read_result_set(spark, base)
    assert {n: [tuple(r) for r in f.orderBy("n").collect()] for n, f in got.items()} == {
        "a": [(1, None), (2, ""), (3, "x,\n\"y\"")], "b": [(0,), (1,), (2,)],
    }
    assert got["a"].schema == one["a"].schema
    assert save_result_set(spark, {"b": two["a"]}, base) == 2
    assert set(read_result_set(spark, base)) == {"b"} and set(read_result_set(spark, base, 1)) == {"a", "b"}


def test_one_writer_per_version(spark):
    base = fresh_path(spark, "versions")
    assert latest_version(spark, base) is None
    commit_version(spark, base, 1, {"x": [1]})
    with pytest.raises(Exception, match="(?i)exists"):
        commit_version(spark, base, 1, {"x": [2]})
    commit_version(spark, base, 2, {"x": [3]})
    assert latest_version(spark, base) == {"x": [3], "number": 2}


def test_long_form_holds_every_measure(spark, logs):
    results = analyze_one_by_one(logs)
    assert set(results) == set(RESULT_KEYS)
    rows = {(r["result"], r["key"], r["measure"]): (r["number"], r["text"]) for r in long_form({n: results[n] for n in ("kpi_summary", "endpoint_method_pairs", "session_patterns")}).collect()}
    kpi = results["kpi_summary"].first().asDict()
    assert {m: n if n is not None else t for (r, _, m), (n, t) in rows.items() if r == "kpi_summary"} == pytest.approx(kpi)
    assert sum(1 for r, _, _ in rows if r == "session_patterns") == 4 * results["session_patterns"].count()
