"""Packed storage: files per date whatever the input's layout, and look-ups that skip row groups."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loglens.session import fresh_path
from loglens.sinks.landing import land_partitioned
from loglens.sinks.packing import pack_conf, rebalanced, session_conf, write_packed
from loglens.sources.fixture import load_logs
from loglens.sources.log_table import read_log_table, store_logs
from loglens.sources.lookup import LOOKUP_KEYS, find_logs, store_lookup_logs
from loglens.sources.results import file_inventory
from tests.conftest import SF_SMALL
from tests.test_io import same_rows


def files_per_day(spark, path):
    day = F.regexp_extract("path", r"/date=([^/]+)/", 1).alias("date")
    return {r["date"]: r["n"] for r in file_inventory(spark, path).groupBy(day).agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("parts", [1, 16])
def test_one_file_per_date_however_the_rows_arrive(spark, logs, parts):
    path = store_logs(spark, logs.repartition(parts))
    files = files_per_day(spark, path)
    assert len(files) == 30 and set(files.values()) == {1}
    assert same_rows(read_log_table(spark, path, schema=logs.schema), logs)
    # without packing, every task writes a file for every date that it holds
    loose = files_per_day(spark, store_logs(spark, logs.repartition(16), cluster=False))
    assert sum(loose.values()) > 200


def test_a_busy_day_is_split_and_a_quiet_one_is_not(spark):
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 50 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("date").alias("date"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    path = write_packed(rows.repartition(8), fresh_path(spark, "skewed"), ["date"], file_bytes=2 << 20)
    files = files_per_day(spark, path)
    assert files["2024-01-02"] == 1 and 4 <= files["2024-01-01"] <= 30
    sizes = [r["length"] for r in file_inventory(spark, path).collect()]
    assert max(sizes) < 3 * (2 << 20)
    assert spark.read.parquet(path).count() == 400_000


def test_packing_is_planned_at_run_time_and_settings_come_back(spark, logs):
    plan = rebalanced(logs.withColumn("date", F.to_date("timestamp")), ["date"])._jdf.queryExecution().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    with session_conf(spark, pack_conf(1 << 20)):
        assert spark.conf.get(key) == str(2 << 20)
    assert spark.conf.get(key, None) == before
    with pytest.raises(ValueError), session_conf(spark, {key: "1m"}):
        raise ValueError
    assert spark.conf.get(key, None) == before


def test_landing_by_date_is_packed(spark, logs):
    base = land_partitioned(logs.repartition(16), fresh_path(spark, "landed"))
    assert set(files_per_day(spark, base).values()) == {1}


def test_empty_logs_and_missing_timestamps(spark, logs):
    path = store_logs(spark, logs.limit(0))
    assert read_log_table(spark, path, schema=logs.schema).count() == 0
    undated = logs.limit(5).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    assert same_rows(read_log_table(spark, store_logs(spark, undated), schema=logs.schema), undated)


def scanned(df) -> int:
    """Rows that the file scans of ``df`` handed on (after row-group skipping)."""
    df.write.format("noop").mode("overwrite").save()
    frame = df._jdf.queryExecution()
    frame.executedPlan().execute().count()

    def walk(plan):
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        found = plan.metrics().get("numOutputRows").get().value() if "FileSourceScanExec" in plan.getClass().getSimpleName() else 0
        children = plan.children()
        return found + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(frame.executedPlan())


def test_look_ups_skip_row_groups(spark):
    rows = spark.range(60_000).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 80000)").alias("timestamp"),
        # users in ranges when sorted; sessions and addresses strewn over all row groups
        F.concat(F.lit("user_"), F.lpad((F.col("id") * 7919 % 3000).cast("string"), 6, "0")).alias("user_id"),
        F.concat(F.lit("sess_"), F.sha2((F.col("id") / 3).cast("long").cast("string"), 256)).alias("session_id"),
        F.sha2((F.col("id") % 20_000).cast("string"), 224).alias("ip_address"),
    )
    path = store_lookup_logs(spark, rows, row_group_bytes=256 << 10, expected=5000)
    assert set(files_per_day(spark, path).values()) == {1}
    first = rows.filter("event_id = 4711").first()
    for key in LOOKUP_KEYS:
        found = find_logs(spark, path, rows.schema, **{key: first[key]})
        assert same_rows(found, rows.filter(F.col(key) == first[key]))
        assert f"EqualTo({key}," in found._jdf.queryExecution().executedPlan().toString()
        assert 0 < scanned(found) < 30_000, key
    both = find_logs(spark, path, rows.schema, user_id=[first["user_id"], "nobody"], session_id=first["session_id"])
    assert [r["event_id"] // 3 for r in both.collect()] == [4711 // 3]
    assert find_logs(spark, path, rows.schema, session_id="nobody's").count() == 0
    assert find_logs(spark, path, rows.schema, dates=["2024-01-02"], user_id=first["user_id"]).count() == 0
    # it is the row groups' filters that skip: without them the same look-up reads nearly all of its day
    off = {f"parquet.filter.{kind}.enabled": "false" for kind in ("bloom", "dictionary")}
    plain = spark.read.options(**off).schema(rows.schema).parquet(path).filter(F.col("ip_address") == first["ip_address"])
    assert scanned(plain) > 2 * scanned(find_logs(spark, path, rows.schema, ip_address=first["ip_address"]))


def test_look_up_of_the_log_view(spark):
    logs = load_logs(spark, SF_SMALL)
    path = store_lookup_logs(spark, logs)
    session = logs.agg(F.max("session_id")).first()[0]
    assert same_rows(find_logs(spark, path, session_id=session), logs.filter(F.col("session_id") == session))
