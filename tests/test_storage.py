"""Replayed drops, the kept file list and bucketed tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from loglens import operators as ops
from loglens.plans.catalog import RAW_WITH_ID
from loglens.session import fresh_path
from loglens.sinks.landing import land_lines, land_raw
from loglens.sources.bucketed import store_bucketed
from loglens.sources.file_manifest import FileManifest, listed
from loglens.streaming.ingest import ingest, ingest_summary, read_ingested
from tests.test_io import same_rows


def test_a_drop_sent_twice_gives_the_same_table(spark, logs):
    base = fresh_path(spark, "replay")
    some = logs.filter("event_id < 300")
    for drop in ("a", "b"):  # the same records under other file names
        land_raw(some.repartition(2 if drop == "a" else 3), f"{base}/raw/drop={drop}")
        ingest(spark, f"{base}/raw/*", f"{base}/table", f"{base}/ck", schema=RAW_WITH_ID, key="event_id")
    table = read_ingested(spark, f"{base}/table")
    assert same_rows(table.drop("date"), some)
    # a late line lands under its own date, and an old record with a new one in one file is told apart
    late = logs.filter("event_id BETWEEN 290 AND 305").withColumn("timestamp", F.expr("timestamp - INTERVAL 400 DAYS"))
    land_raw(late, f"{base}/raw/drop=c")
    ingest(spark, f"{base}/raw/*", f"{base}/table", f"{base}/ck", schema=RAW_WITH_ID, key="event_id")
    got = read_ingested(spark, f"{base}/table")
    assert got.count() == 306 and got.filter("year(date) = 2022").count() == 6
    # without a key every arrival counts, as before
    ingest(spark, f"{base}/raw/*", f"{base}/plain", f"{base}/ck-plain", schema=RAW_WITH_ID)
    assert read_ingested(spark, f"{base}/plain").count() == 616


def test_rejects_are_their_own_key(spark):
    base = fresh_path(spark, "replay-rejects")
    lines = ['{"event_id": 1, "timestamp": "2024-01-01T00:00:00Z"}', '{"event_id": 1, "timestamp": "2024-01-01T00:00:00Z"}', "no json", "no json", "other"]
    land_lines(spark.createDataFrame([(x,) for x in lines], "value string"), f"{base}/raw/a")
    ingest(spark, f"{base}/raw/*", f"{base}/table", f"{base}/ck", schema=RAW_WITH_ID, key="event_id")
    assert {r["status"]: r["records"] for r in ingest_summary(spark, f"{base}/table").collect()} == {"accepted": 1, "malformed": 2}


def names(frame):
    return sorted((r["file"].split("/")[0], r["status"]) for r in frame.collect())


def test_manifest_follows_writes_without_listing_the_tree(spark):
    base, path = fresh_path(spark, "tree"), fresh_path(spark, "tree-manifest")
    manifest = FileManifest(spark, path, base)
    assert manifest.files().count() == 0
    lines = spark.range(50).select(F.col("id").cast("string").alias("value"))
    for zone, part in (("raw", lines), ("results", lines.limit(3))):
        land_lines(part.coalesce(2), f"{base}/{zone}")
        assert manifest.sync(zone) >= 1 and manifest.sync(zone) == 0
    want = {r["zone"]: (r["files"], r["bytes"]) for r in listed(spark, base).groupBy(F.substring_index("file", "/", 1).alias("zone")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes")).collect()}
    usage = manifest.usage()
    assert {r["zone"]: (r["files"], r["bytes"]) for r in usage.collect()} == want
    kept = path.rsplit("/", 1)[-1]
    assert usage.inputFiles() and all(kept in f for f in usage.inputFiles())  # the answer reads the manifest, not the tree
    assert manifest.differences().collect() == []
    # a write that the manifest was not told of shows up, and is taken over
    land_lines(lines.limit(7).coalesce(1), f"{base}/raw")
    assert set(names(manifest.differences())) == {("raw", "added"), ("raw", "gone")}
    manifest.sync()
    assert manifest.differences().collect() == [] and manifest.usage().filter("zone = 'raw'").first()["files"] == 1
    assert FileManifest(spark, path, base).files().count() == manifest.files().count()


@pytest.fixture(scope="module")
def bucketed(spark, logs):
    return store_bucketed(spark, logs, "test_bucketed_logs", 4)


def test_reports_over_buckets_need_no_shuffle_of_keys(spark, logs, bucketed):
    assert same_rows(bucketed, logs)
    users = ops.user_activity(bucketed)
    assert [tuple(r) for r in users.collect()] == [tuple(r) for r in ops.user_activity(logs).collect()]
    sessions = ops.session_patterns(bucketed)
    assert [tuple(r) for r in sessions.collect()] == [tuple(r) for r in ops.session_patterns(logs).collect()]
    rank = bucketed.filter("user_id IS NOT NULL").groupBy("user_id").agg(F.count("*").alias("n"))
    for frame in (rank, bucketed.groupBy("session_id", "user_id").count()):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
    for frame, key in ((users, "user_id"), (sessions, "session_id")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search(rf"Exchange hashpartitioning\({key}#\d+(, user_id#\d+)?, \d+\)", plan)  # no ranking shuffle
    direct = ops.user_activity(logs)
    direct.collect()
    assert re.search(r"Exchange hashpartitioning\(user_id#\d+, \d+\)", direct._jdf.queryExecution().executedPlan().toString())


def test_one_file_per_bucket(spark, bucketed):
    assert len(bucketed.inputFiles()) <= 4
