"""The registered queries: key -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the whole ``events`` table of ``sf_dir`` through the log
view (or files that Spark writes from it), so its work grows with the data.
The analyses read the log table (:mod:`loglens.sources.log_table`), which is
written once per session; the landing queries start from the view itself.
"""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .. import operators as ops
from ..functions.columns import with_time_columns
from ..operators.heavy_hitters import heavy_ip_frequency, heavy_session_patterns, heavy_top_endpoints, heavy_user_activity
from ..schema import RAW_SCHEMA, RESULT_SCHEMAS, with_field
from ..session import fresh_path
from ..sinks.landing import land_lines, land_partitioned, land_raw, save_result_csv, to_raw
from ..sinks.packing import FILE_BYTES
from ..sinks.result_sets import read_result_set, save_result_set
from ..sources.bucketed import store_bucketed
from ..sources.file_manifest import FileManifest
from ..sources.fixture import load_logs
from ..sources.log_table import log_table, store_logs
from ..sources.lookup import find_logs, store_lookup_logs
from ..sources.json_logs import read_json_logs, read_partitioned_logs, read_with_rejects, reject_summary
from ..sources.results import file_inventory, read_result_csv, zone_status, zone_usage
from ..streaming.ingest import ingest, ingest_summary, read_ingested
from .daily_state import DailyState
from .one_scan import analyze_in_one_scan
from .report import BOUNDED_RESULTS, long_form, result_order
from .sql_functions import register_functions
from .views import register_views

Query = Callable[[SparkSession, str], DataFrame]

# A support threshold no group can pass (no group has more rows than this),
# so the minimum-support fallback branch runs.
UNREACHABLE_SUPPORT = 2**63 - 1


def _on_logs(analysis: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return analysis(log_table(spark, sf_dir))

    run.__name__ = getattr(analysis, "__name__", "query")
    run.__doc__ = analysis.__doc__
    return run


ANALYSES: dict[str, Query] = {
    "level_distribution": _on_logs(ops.level_distribution),
    "top_endpoints": _on_logs(ops.top_endpoints),
    "error_analysis": _on_logs(ops.error_analysis),
    "server_performance": _on_logs(ops.server_performance),
    "hourly_traffic": _on_logs(ops.hourly_traffic),
    "daily_traffic": _on_logs(ops.daily_traffic),
    "user_activity": _on_logs(ops.user_activity),
    "session_patterns": _on_logs(ops.session_patterns),
    "error_count": _on_logs(ops.error_count),
    "ip_frequency": _on_logs(ops.ip_frequency),
    "unique_endpoints": _on_logs(ops.unique_endpoints),
    "null_counts": _on_logs(ops.null_counts),
    "endpoint_method_pairs": _on_logs(ops.endpoint_method_pairs),
    "support_fallback": _on_logs(lambda logs: ops.frequent_pairs_with_fallback(logs, min_support=UNREACHABLE_SUPPORT)),
    "support_pass_through": _on_logs(lambda logs: ops.frequent_pairs_with_fallback(logs, min_support=5)),
    "error_patterns": _on_logs(ops.error_patterns),
    "error_patterns_fallback": _on_logs(ops.error_patterns_with_fallback),
    "pattern_statistics": _on_logs(ops.pattern_statistics),
    "server_activity": _on_logs(ops.server_activity),
    "kpi_summary": _on_logs(ops.kpi_summary),
    "simple_count": _on_logs(ops.simple_count),
    "level_counts": _on_logs(ops.level_counts),
    "server_requests_avg": _on_logs(ops.server_requests_avg),
    "hour_counts": _on_logs(ops.hour_counts),
    "endpoint_method_top20": _on_logs(ops.endpoint_method_top),
    "distinct_endpoints": _on_logs(ops.distinct_endpoints),
    "server_key_counts": _on_logs(ops.server_key_counts),
    "error_server_times": _on_logs(ops.error_server_times),
    "heavy_endpoints": _on_logs(heavy_top_endpoints),
    "heavy_addresses": _on_logs(heavy_ip_frequency),
    "heavy_users": _on_logs(heavy_user_activity),
    "heavy_sessions": _on_logs(heavy_session_patterns),
    "time_columns": _on_logs(with_time_columns),
    "sample_rows": _on_logs(lambda logs: ops.sample_rows(logs, key=["event_id"])),
}


# The log view keeps its unique ``event_id`` through every landing.
RAW_WITH_ID = with_field(RAW_SCHEMA, "event_id", LongType(), position=0)

# The day read back by the partition-pruning check.
PRUNED_DAY = "2024-01-15"


def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the logs as JSON Lines, then scan them back with the fixed schema."""
    path = land_raw(load_logs(spark, sf_dir), fresh_path(spark, "raw"))
    return read_json_logs(spark, path, RAW_WITH_ID)


def scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the logs by date partition, then read the whole layout back."""
    base = land_partitioned(load_logs(spark, sf_dir), fresh_path(spark, "partitioned"))
    return read_partitioned_logs(spark, base, schema=RAW_WITH_ID)


def partition_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the logs by date partition, then read one day (directory pruning)."""
    base = land_partitioned(load_logs(spark, sf_dir), fresh_path(spark, "partitioned"))
    return read_partitioned_logs(spark, base, dates=[PRUNED_DAY], schema=RAW_WITH_ID)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save the session-pattern result (a top 10) as one CSV file and read it back typed."""
    result = ops.session_patterns(load_logs(spark, sf_dir))
    path = save_result_csv(result, fresh_path(spark, "results-csv"), single_file=True)
    return read_result_csv(spark, path, RESULT_SCHEMAS["session_patterns"])


def scan_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan JSON Lines in which every 7th status code is quoted and every 11th response time fractional."""
    raw = to_raw(load_logs(spark, sf_dir))
    rest = F.to_json(F.struct(*[c for c in raw.columns if c not in ("status_code", "response_time")]))
    status, time, eid = F.col("status_code").cast("string"), F.col("response_time").cast("string"), F.col("event_id")
    status = F.when(eid % 7 == 0, F.concat(F.lit('"'), status, F.lit('"'))).otherwise(status)
    time = F.when(eid % 11 == 0, F.concat(time, F.lit(".5"))).otherwise(time)
    null = F.lit("null")
    line = F.concat(
        F.left(rest, F.length(rest) - 1),
        F.lit(',"status_code":'), F.coalesce(status, null),
        F.lit(',"response_time":'), F.coalesce(time, null), F.lit("}"),
    )
    path = land_lines(raw.select(line.alias("value")), fresh_path(spark, "mixed"))
    return read_json_logs(spark, path, RAW_WITH_ID)


def _damaged_lines(logs: DataFrame, bad_numbers: bool = False) -> DataFrame:
    """Log lines where some client addresses send damaged records.

    Lines from addresses ending in ``.113`` arrive cut in half (malformed);
    lines from addresses ending in ``.142`` carry an unparsable timestamp; with
    ``bad_numbers``, those from ``.121`` a status code that is no number.
    """
    raw = to_raw(logs)
    ip = F.col("ip_address")
    if bad_numbers:
        code = F.when(ip.endswith(".121"), F.lit("n/a")).otherwise(F.col("status_code").cast("string"))
        raw = raw.withColumn("status_code", code)
    raw = raw.withColumn("timestamp", F.when(ip.endswith(".142"), F.lit("bad")).otherwise(F.col("timestamp")))
    line = F.to_json(F.struct(*[F.col(c) for c in raw.columns]))
    cut = F.left(line, (F.length(line) / 2).cast("int"))
    return raw.select(F.when(ip.endswith(".113"), cut).otherwise(line).alias("value"))


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``status, records``: accepted lines and rejects per reason after a damaged landing."""
    path = land_lines(_damaged_lines(load_logs(spark, sf_dir)), fresh_path(spark, "damaged"))
    return reject_summary(read_with_rejects(spark, path, RAW_WITH_ID))


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``status, records`` of a damaged drop after it was ingested: table rows and rejects per reason."""
    base = fresh_path(spark, "stream-rejects")
    land_lines(_damaged_lines(load_logs(spark, sf_dir), bad_numbers=True), f"{base}/raw/drop=1")
    ingest(spark, f"{base}/raw/*", f"{base}/table", f"{base}/_checkpoint", schema=RAW_WITH_ID)
    return ingest_summary(spark, f"{base}/table")


def _landed_zones(spark: SparkSession, sf_dir: str) -> str:
    """Text lines of all events, of the errors, and of nothing, in three zones."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    line = F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value")
    base = fresh_path(spark, "zones")
    land_lines(events.select(line), f"{base}/events")
    land_lines(events.filter("event_type = 'error'").select(line), f"{base}/errors")
    land_lines(events.filter("event_id IS NULL AND event_type IS NULL").select(line), f"{base}/nothing")
    return base


def file_inventory_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zone, status, bytes, rows``: what landed in each zone, from the file listing and the lines read."""
    zones = ["events", "errors", "nothing", "nowhere"]
    return zone_status(spark, _landed_zones(spark, sf_dir), zones).select("zone", "status", "bytes", "rows")


def zone_usage_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zone, bytes`` of the zones that hold something."""
    base = _landed_zones(spark, sf_dir)
    return zone_usage(file_inventory(spark, base), base).filter("bytes > 0").select("zone", "bytes")


def partition_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``records, consistent``: the records of all partitions, and whether they add up to the table."""
    table = log_table(spark, sf_dir)
    counted = table.agg(F.count("*").alias("n")).scalar()
    total = ops.partition_profile(table).agg(F.coalesce(F.sum("records"), F.lit(0)).alias("records"))
    return total.select("records", (F.col("records") == counted).alias("consistent"))


def sql_logs_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests and errors per hour, asked in SQL over the registered views."""
    register_views(spark, log_table(spark, sf_dir), prefix="catalog_")
    return spark.sql("""
        SELECT date, hour, COUNT(*) AS requests, COUNT_IF(status_code >= 400) AS errors,
               (SELECT COUNT(*) FROM catalog_logs) AS all_requests
        FROM catalog_logs_time GROUP BY date, hour ORDER BY date, hour""")


def saved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results of the report, saved as one set of CSV files and read back through its manifest."""
    results = analyze_in_one_scan(spark, log_table(spark, sf_dir))
    base = fresh_path(spark, "saved-report")
    save_result_set(spark, results, base, BOUNDED_RESULTS, {n: result_order(n) for n in results})
    return long_form(read_result_set(spark, base))


def one_scan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results of the one-scan report, one below the other."""
    return long_form(analyze_in_one_scan(spark, log_table(spark, sf_dir)))


# The days of the range reports.
RANGE = ("2024-01-10", "2024-01-20")


def _range_days() -> list[dt.date]:
    first, last = (dt.date.fromisoformat(d) for d in RANGE)
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


def _daily_state(spark: SparkSession, sf_dir: str) -> DailyState:
    """The daily state after two drops and a day that lands again."""
    logs = log_table(spark, sf_dir)
    early = F.dayofmonth("timestamp") <= 15
    state = DailyState.open(spark, fresh_path(spark, "daily-state"))
    # the first drop has only half of one day; the whole day lands later
    state = state.refresh(logs.filter(early & ((F.to_date("timestamp") != F.lit(RANGE[0]).cast("date")) | (F.hour("timestamp") < 12))))
    state = state.refresh(logs.filter(~early | F.col("timestamp").isNull()))
    return state.refresh(logs, days=[RANGE[0]])


def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results of the report from groups kept per day and refreshed in three steps."""
    return long_form(_daily_state(spark, sf_dir).results())


def daily_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results of the report over a range of days, from the groups kept per day."""
    return long_form(_daily_state(spark, sf_dir).results(_range_days()))


def distinct_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct counts over a range of days, from the bitmaps kept per day."""
    return _daily_state(spark, sf_dir).distinct_counts(_range_days()).select("metric", "key", "count", "has_null")


def packed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``date, records, packed``: the log table's days, and whether each has about a file per ``FILE_BYTES``."""
    path = store_logs(spark, load_logs(spark, sf_dir))
    day = F.regexp_extract("path", r"/date=([^/]+)/", 1).cast("date")
    files = file_inventory(spark, path).groupBy(day.alias("date")).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
    rows = spark.read.parquet(path).groupBy("date").agg(F.count("*").alias("records"))
    most = 1 + F.ceil(2 * F.col("bytes") / F.lit(FILE_BYTES))
    return rows.join(files, "date").select("date", "records", (F.col("files") <= most).alias("packed"))


def lookup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``by, event_id``: the rows of the last user, the last session and the first address, found by look-up."""
    logs = load_logs(spark, sf_dir)
    path = store_lookup_logs(spark, logs)
    wanted = logs.agg(F.max("user_id").alias("user_id"), F.max("session_id").alias("session_id"), F.min("ip_address").alias("ip_address")).first()
    parts = [
        find_logs(spark, path, logs.schema, **{key: value}).select(F.lit(key).alias("by"), "event_id")
        for key, value in wanted.asDict().items()
        if value is not None
    ]
    none = logs.select(F.lit("").alias("by"), "event_id").limit(0)
    return functools.reduce(DataFrame.unionByName, parts, none)


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with parameters, asked in SQL through table functions."""
    register_views(spark, log_table(spark, sf_dir), prefix="catalog_")
    register_functions(spark, prefix="catalog_")
    return spark.sql("""
        SELECT 'endpoints' AS report, endpoint AS key, requests AS n FROM catalog_top_endpoints(k => 7)
        UNION ALL SELECT 'addresses', ip_address, requests FROM catalog_top_addresses()
        UNION ALL SELECT 'users', user_id, requests FROM catalog_busiest_users(20)
        UNION ALL SELECT 'sessions', session_id, page_views FROM catalog_busiest_sessions(k => 3)
        UNION ALL SELECT 'pairs', concat(endpoint, ' ', method), frequency FROM catalog_frequent_pairs(3, 12)
        UNION ALL SELECT 'errors', concat(server, ' ', endpoint, ' ', status_code), frequency FROM catalog_recurring_errors(k => 6, error_from => 500)
        UNION ALL SELECT 'traffic', concat(date, ' ', hour), requests * 1000 + errors
                  FROM catalog_traffic_between(TIMESTAMP_NTZ '2024-01-10 06:00:00', TIMESTAMP_NTZ '2024-01-12 00:00:00')
        UNION ALL SELECT 'slow', server, max_response_ms FROM catalog_slow_servers(300.0)""")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs arrive as JSON files in two drops (first half of the days, then the
    rest); each drop is ingested incrementally into a date-partitioned Parquet
    table, and the table is read back."""
    logs = load_logs(spark, sf_dir)
    base = fresh_path(spark, "stream")
    raw, table, checkpoint = f"{base}/raw", f"{base}/table", f"{base}/_checkpoint"
    early = F.dayofmonth("timestamp") <= 15
    land_raw(logs.filter(early), f"{raw}/drop=1")
    ingest(spark, f"{raw}/*", table, checkpoint, schema=RAW_WITH_ID)
    land_raw(logs.filter(~early), f"{raw}/drop=2")
    ingest(spark, f"{raw}/*", table, checkpoint, schema=RAW_WITH_ID)
    return read_ingested(spark, table)


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop that arrives twice under different names and a later one, ingested by record: the table has every log once."""
    logs = load_logs(spark, sf_dir)
    base = fresh_path(spark, "stream-replay")
    raw, table, checkpoint = f"{base}/raw", f"{base}/table", f"{base}/_checkpoint"
    early = F.dayofmonth("timestamp") <= 15
    for drop, part in enumerate([early, early, ~early]):
        land_raw(logs.filter(part), f"{raw}/drop={drop}")
        ingest(spark, f"{raw}/*", table, checkpoint, schema=RAW_WITH_ID, key="event_id")
    return read_ingested(spark, table)


def manifest_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``zone, bytes, checked``: usage from the kept file list, and whether a listing of the zones agrees with it."""
    base = _landed_zones(spark, sf_dir)
    manifest = FileManifest(spark, fresh_path(spark, "file-manifest"), base)
    for zone in ("events", "errors", "nothing"):
        manifest.sync(zone)
    odd = manifest.differences().select(F.substring_index("file", "/", 1).alias("zone")).distinct()
    used = manifest.usage().filter("bytes > 0").select("zone", "bytes")
    return used.join(odd.withColumn("odd", F.lit(True)), "zone", "left").select("zone", "bytes", F.col("odd").isNull().alias("checked"))


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return store_bucketed(spark, log_table(spark, sf_dir), "loglens_bucketed_logs", buckets)


def bucketed_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User activity over the log table in buckets by user."""
    return ops.user_activity(_bucketed(spark, sf_dir))


def bucketed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session patterns over the log table in buckets by user."""
    return ops.session_patterns(_bucketed(spark, sf_dir))


SOURCES_AND_SINKS: dict[str, Query] = {
    "scan_json": scan_json,
    "scan_partitioned": scan_partitioned,
    "partition_day": partition_day,
    "csv_round_trip": csv_round_trip,
    "rejects": rejects,
    "scan_mixed_types": scan_mixed_types,
    "ingest_rejects": ingest_rejects,
    "sql_logs_time": sql_logs_time,
    "sql_functions": sql_functions,
    "packed_table": packed_table,
    "lookup_rows": lookup_rows,
    "daily_report": daily_report,
    "daily_range": daily_range,
    "distinct_range": distinct_range,
    "saved_report": saved_report,
    "one_scan_report": one_scan_report,
    "profile_input": _on_logs(ops.profile_input),
    "partition_profile": partition_profile_query,
    "file_inventory": file_inventory_query,
    "zone_usage": zone_usage_query,
    "stream_ingest": stream_ingest,
    "stream_replay": stream_replay,
    "manifest_usage": manifest_usage,
    "bucketed_users": bucketed_users,
    "bucketed_sessions": bucketed_sessions,
}


def all_queries() -> dict[str, Query]:
    return {**ANALYSES, **SOURCES_AND_SINKS}
