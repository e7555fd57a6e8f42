"""All named analyses at once, saving them as a set of CSV results, and the
whole flow from raw log files to saved results."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import ordering
from ..session import fresh_path
from ..sinks.landing import SaveError, root_cause, save_results
from ..sources.json_logs import RAW_LINE, REJECT_REASON, read_partitioned_with_rejects, read_with_rejects
from ..streaming.ingest import ACCEPTED, REJECTED, STATUS, read_ingest_rejects, read_ingested
from .one_scan import analyze_in_one_scan
from .views import ANALYSIS_VIEWS

# How the rows of each sorted result are ordered: descending measures, then ascending keys.
_SORTED: dict[str, tuple[list[str], list[str]]] = {
    "level_distribution": (["count"], ["level"]),
    "top_endpoints": (["requests"], ["endpoint"]),
    "error_analysis": (["count"], ["status_code"]),
    "server_performance": (["avg_response_ms"], ["server"]),
    "hourly_traffic": ([], ["hour"]),
    "daily_traffic": ([], ["date"]),
    "user_activity": (["requests"], ["user_id"]),
    "session_patterns": (["page_views"], ["session_id", "user_id"]),
    "ip_frequency": (["requests"], ["ip_address"]),
    "endpoint_method_pairs": (["frequency"], ["endpoint", "method"]),
    "error_patterns": (["frequency"], ["server", "endpoint", "status_code"]),
    "server_activity": (["requests"], ["server"]),
    "server_requests_avg": (["requests"], ["server"]),
    "hour_counts": ([], ["hour"]),
    "endpoint_method_top20": (["requests"], ["endpoint", "method"]),
}


# The columns that name a row of each result; the others are its measures.
RESULT_KEYS: dict[str, list[str]] = {
    "level_distribution": ["level"],
    "level_counts": ["level"],
    "top_endpoints": ["endpoint"],
    "error_analysis": ["status_code"],
    "error_count": [],
    "server_performance": ["server"],
    "server_requests_avg": ["server"],
    "server_key_counts": ["server"],
    "hourly_traffic": ["hour"],
    "hour_counts": ["hour"],
    "daily_traffic": ["date"],
    "ip_frequency": ["ip_address"],
    "null_counts": [],
    "unique_endpoints": [],
    "distinct_endpoints": [],
    "simple_count": [],
    "endpoint_method_pairs": ["endpoint", "method"],
    "endpoint_method_top20": ["endpoint", "method"],
    "error_patterns": ["server", "endpoint", "status_code"],
    "pattern_statistics": [],
    "server_activity": ["server"],
    "kpi_summary": [],
    "user_activity": ["user_id"],
    "session_patterns": ["session_id", "user_id"],
}


def long_form(results: dict[str, DataFrame]) -> DataFrame:
    """Results one below the other, whole: ``result, key, measure, number, text``, a row per row and measure.

    ``key`` joins the naming columns with ``|`` (NULL as ``(null)``). Numbers are in
    ``number``; texts and times, as text, in ``text``.
    """
    parts = []
    for name, frame in results.items():
        keys = [F.coalesce(F.col(c).cast("string"), F.lit("(null)")) for c in RESULT_KEYS[name]]
        measures = []
        for f in frame.schema.fields:
            if f.name in RESULT_KEYS[name]:
                continue
            text, number = F.lit(None).cast("string"), F.lit(None).cast("double")
            if f.dataType.typeName() == "timestamp_ntz":
                text = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
            elif f.dataType.typeName() == "string":
                text = F.col(f.name)
            else:
                number = F.col(f.name).cast("double")
            measures.append(F.struct(F.lit(f.name).alias("measure"), number.alias("number"), text.alias("text")))
        rows = frame.select(F.lit(name).alias("result"), F.concat_ws("|", *keys).alias("key"), F.explode(F.array(*measures)).alias("m"))
        parts.append(rows.select("result", "key", "m.*"))
    return functools.reduce(DataFrame.unionByName, parts)


def result_order(name: str) -> list[Column]:
    """The sort columns of a result (none if its rows have no order)."""
    desc, asc = _SORTED.get(name, ([], []))
    return ordering(desc, asc)


# Results bounded by a top-k, or by one row per level, status code, hour or day;
# each is written as a single CSV file. Results with a row per server, whose
# number follows the fleet, are written in parallel.
BOUNDED_RESULTS = frozenset(
    {
        "level_distribution",
        "top_endpoints",
        "error_analysis",
        "hourly_traffic",
        "daily_traffic",
        "user_activity",
        "session_patterns",
        "ip_frequency",
        "null_counts",
        "endpoint_method_pairs",
        "error_patterns",
        "pattern_statistics",
        "server_activity",
        "kpi_summary",
        "level_counts",
        "error_count",
        "unique_endpoints",
        "distinct_endpoints",
        "simple_count",
        "hour_counts",
        "endpoint_method_top20",
    }
)

# The columns that the report's analyses use.
REPORT_COLUMNS = [
    "timestamp", "level", "server", "ip_address", "method", "endpoint", "status_code", "response_time", "user_id",
    "session_id",
]


class ReportStatus(dict):
    """``name -> "ok"`` of every saved result; ``rejects`` counts the rejected lines per reason."""

    def __init__(self, status: dict[str, str], rejects: dict[str, int]):
        super().__init__(status)
        self.rejects = rejects


def analyze(logs: DataFrame) -> dict[str, DataFrame]:
    """Every named analysis of ``logs``, by name (lazy; nothing runs yet).

    Each result is planned and run on its own when it is used. For many
    results over the same raw files, read the logs from a Parquet table (see
    :func:`loglens.sources.log_table.materialize`) so the raw text is parsed once.
    """
    return {name: fn(logs) for name, fn in ANALYSIS_VIEWS.items()}


def save_report(results: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Save ``results`` under ``base/<name>`` as CSV; returns the status of each."""
    orders = {name: result_order(name) for name in results}
    return save_results(results, base, single_file=BOUNDED_RESULTS & set(results), orders=orders)


def run_report(
    spark: SparkSession,
    source: str,
    out_base: str,
    partitioned: bool = False,
    dates: Iterable[str] | None = None,
    table: bool = False,
    zone_aware: bool = True,
) -> ReportStatus:
    """Load logs, parse them once, compute the whole report, save every result.

    ``source`` is a JSON Lines path or glob, or with ``partitioned`` the base
    of a ``date=`` layout (optionally pruned to ``dates``). Its lines are typed
    once: the accepted records go to a Parquet table in the shared folder (only
    the columns that the report uses), the rejects with their reason to
    ``out_base/_rejects``, and their number per reason is returned. With ``table``
    the source is already columnar (an ingested or stored log table) and is
    analysed as it is, without a copy.

    The results come from :func:`~loglens.plans.one_scan.analyze_in_one_scan`
    and are saved under ``out_base/<name>``. All are tried; if any failed,
    :class:`~loglens.sinks.landing.SaveError` names each with its cause.
    """
    rejects: dict[str, int] = {}
    unsaved: dict[str, str] = {}
    if table:
        logs = read_ingested(spark, source, dates)
    else:
        if partitioned:
            marked = read_partitioned_with_rejects(spark, source, dates, zone_aware=zone_aware)
        else:
            marked = read_with_rejects(spark, source, zone_aware=zone_aware)
        # one pass over the raw text: accepted and rejected lines together, told apart by a partition
        path = fresh_path(spark, "report-logs")
        status = F.when(F.col(REJECT_REASON).isNull(), ACCEPTED).otherwise(REJECTED).alias(STATUS)
        marked.select(*REPORT_COLUMNS, REJECT_REASON, RAW_LINE, status, F.to_date("timestamp").alias("date")).write.partitionBy(
            STATUS, "date"
        ).parquet(path)
        bad = read_ingest_rejects(spark, path)
        try:
            bad.write.mode("overwrite").json(f"{out_base.rstrip('/')}/_rejects")
        except Exception as exc:  # reported with the results, which are tried first
            unsaved = {"_rejects": f"failed: {root_cause(exc)}"}
        rejects = {r[REJECT_REASON]: r["records"] for r in bad.groupBy(REJECT_REASON).agg(F.count("*").alias("records")).collect()}
        logs = read_ingested(spark, path)
    saved = save_report(analyze_in_one_scan(spark, logs), out_base) | unsaved
    if any(text != "ok" for text in saved.values()):
        raise SaveError(saved)
    return ReportStatus(saved, rejects)
