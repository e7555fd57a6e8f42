"""The whole report from one scan of the logs.

Run one by one, the analyses read the log table about twenty times. All but
the user and session reports group by some of (level, endpoint, method, server,
status code), by time or by client address. So one scan counts the rows under
three grouping sets, with ``Expand`` and a map-side partial aggregate in the scan
stage; these *base groups* are written once to the shared folder. The thirteen
sets that the results need (the *cube*) are rolled up from the base groups, not
from the rows, and written too; each result is then a cheap query over it. The
user and session reports keep their own two-pass plans.

Every derived result equals the direct analysis; ``tests/test_one_scan.py``
checks that on the test tables and on random rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as ops
from ..functions.columns import ERROR_FROM, error_flag_count, is_error, mean_of, percent, with_time_columns
from ..functions.ranking import sort_rows, top_k
from ..operators.patterns import ERROR_PATTERN_KEYS, supported
from ..operators.summary import kpi_from_groups
from ..sources.log_table import materialize

# The columns of the first base set; the others are (date, hour) and (ip_address).
JOINT = ["level", "endpoint", "method", "server", "status_code"]
TIME = ["date", "hour"]
BASE_SETS = {"joint": JOINT, "time": TIME, "ip": ["ip_address"]}
BASE_COLUMNS = [c for cols in BASE_SETS.values() for c in cols]

# The sets rolled up from each base set. ``em_ok`` marks rows whose endpoint and
# method are both set (the rows the pattern statistics count).
ROLLUPS: dict[str, dict[str, tuple[str, ...]]] = {
    "joint": {
        "level": ("level",),
        "endpoint": ("endpoint",),
        "status": ("status_code",),
        "server": ("server",),
        "pair": ("endpoint", "method"),
        "error_triple": ("server", "endpoint", "status_code"),
        "server_endpoint": ("server", "endpoint"),
        "server_method": ("server", "method"),
        "server_em": ("server", "em_ok"),
        "all": (),
    },
    "time": {"hour": ("hour",), "date": ("date",)},
    "ip": {"ip": ("ip_address",)},
}


def _gid(columns: list[str], grouped: tuple[str, ...]) -> int:
    """``grouping_id()`` of a set: bit i (from the left) is 1 when column i is not grouped."""
    return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in grouped)


def base_groups(logs: DataFrame, error_from: int = ERROR_FROM) -> DataFrame:
    """Counts, errors and response times of all rows under the three base sets (lazy; one scan)."""
    sets = [list(cols) for cols in BASE_SETS.values()]
    groups = with_time_columns(logs).groupingSets(sets, *BASE_COLUMNS).agg(
        F.grouping_id().alias("gid"),
        F.count("*").alias("n"),
        error_flag_count("status_code", error_from).alias("errors"),
        F.sum("response_time").alias("rt_sum"),
        F.count("response_time").alias("rt_count"),
        F.max("response_time").alias("rt_max"),
    )
    return groups


def report_cube(base: DataFrame) -> DataFrame:
    """The thirteen sets that the results derive from, rolled up from :func:`base_groups`.

    ``part`` names the set; ``rt_avg`` is the mean response time of a group.
    """
    parts = []
    for name, sets in ROLLUPS.items():
        rows = base.filter(F.col("gid") == _gid(BASE_COLUMNS, tuple(BASE_SETS[name])))
        columns = list(BASE_SETS[name])
        if name == "joint":
            rows = rows.withColumn("em_ok", F.col("endpoint").isNotNull() & F.col("method").isNotNull())
            columns.append("em_ok")
        part = F.lit(None).cast("string")
        for s, cols in sets.items():
            part = F.when(F.col("_gid") == _gid(columns, cols), s).otherwise(part)
        rolled = rows.groupingSets([list(c) for c in sets.values()], *columns).agg(
            F.grouping_id().alias("_gid"),
            F.sum("n").alias("n"),
            F.sum("errors").alias("errors"),
            mean_of(F.sum("rt_sum"), F.sum("rt_count")).alias("rt_avg"),
            F.max("rt_max").alias("rt_max"),
        )
        parts.append(rolled.withColumn("part", part).drop("_gid"))
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _set(cube: DataFrame, name: str) -> DataFrame:
    return cube.filter(F.col("part") == name)


def _total(cube: DataFrame) -> Column:
    return _set(cube, "all").agg(F.sum("n")).scalar()


def _not_null(*names: str) -> Column:
    return functools.reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])


def derive(cube: DataFrame, error_from: int = ERROR_FROM) -> dict[str, DataFrame]:
    """Every small-domain result, from the cube. Names and columns match the direct analyses."""
    total = _total(cube)
    by_level = _set(cube, "level")
    by_endpoint = _set(cube, "endpoint")
    by_status = _set(cube, "status")
    by_server = _set(cube, "server")
    pairs = _set(cube, "pair")
    good_pairs = pairs.filter(_not_null("endpoint", "method"))
    errors = _set(cube, "error_triple").filter((F.col("status_code") >= error_from) & _not_null("server", "endpoint"))
    server_rows = cube.filter(F.col("part").isin("server", "server_endpoint", "server_method"))

    out: dict[str, DataFrame] = {}
    out["level_distribution"] = sort_rows(
        by_level.select("level", F.col("n").alias("count"), percent("n", total).alias("percentage")),
        desc=["count"],
        asc=["level"],
    )
    out["level_counts"] = by_level.select("level", F.col("n").alias("count"))
    out["top_endpoints"] = top_k(by_endpoint.select("endpoint", F.col("n").alias("requests")), 10, ["requests"], ["endpoint"])
    out["error_analysis"] = sort_rows(
        by_status.filter(F.col("status_code") >= error_from).select(
            "status_code", F.col("n").alias("count"), percent("n", total).alias("error_rate")
        ),
        desc=["count"],
        asc=["status_code"],
    )
    out["error_count"] = by_status.agg(F.coalesce(F.sum(F.when(is_error("status_code", error_from), F.col("n"))), F.lit(0)).alias("count"))
    out["server_performance"] = sort_rows(
        by_server.select(
            "server",
            F.col("n").alias("total_requests"),
            F.round("rt_avg", 2).alias("avg_response_ms"),
            F.col("rt_max").alias("max_response_ms"),
        ),
        desc=["avg_response_ms"],
        asc=["server"],
    )
    out["server_requests_avg"] = sort_rows(
        by_server.select("server", F.col("n").alias("requests"), F.col("rt_avg").alias("avg_time")),
        desc=["requests"],
        asc=["server"],
    )
    out["server_key_counts"] = by_server.select("server", F.col("n").alias("count"))
    out["hourly_traffic"] = sort_rows(
        _set(cube, "hour").select(
            "hour", F.col("n").alias("requests"), F.round("rt_avg", 2).alias("avg_response_time"), "errors"
        ),
        asc=["hour"],
    )
    out["hour_counts"] = sort_rows(_set(cube, "hour").select("hour", F.col("n").alias("requests")), asc=["hour"])
    out["daily_traffic"] = sort_rows(
        _set(cube, "date").select(
            "date",
            F.col("n").alias("requests"),
            F.round("rt_avg", 2).alias("avg_response_time"),
            percent("errors", "n").alias("error_rate"),
        ),
        asc=["date"],
    )
    out["ip_frequency"] = top_k(_set(cube, "ip").select("ip_address", F.col("n").alias("requests")), 5, ["requests"], ["ip_address"])
    out["null_counts"] = cube.agg(
        F.coalesce(F.sum(F.when((F.col("part") == "endpoint") & F.col("endpoint").isNull(), F.col("n"))), F.lit(0)).alias("null_endpoints"),
        F.coalesce(F.sum(F.when((F.col("part") == "pair") & F.col("method").isNull(), F.col("n"))), F.lit(0)).alias("null_methods"),
        F.coalesce(F.sum(F.when((F.col("part") == "server") & F.col("server").isNull(), F.col("n"))), F.lit(0)).alias("null_servers"),
    )
    out["unique_endpoints"] = by_endpoint.agg(F.count("endpoint").alias("count"))
    out["distinct_endpoints"] = by_endpoint.agg(F.count("*").alias("count"))
    out["simple_count"] = _set(cube, "all").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"))
    pair_freq = good_pairs.select("endpoint", "method", F.col("n").alias("frequency"))
    out["endpoint_method_pairs"] = top_k(
        supported(pair_freq, 5, fallback=True).withColumn("percentage", percent("frequency", total)),
        10,
        ["frequency"],
        ["endpoint", "method"],
    )
    out["endpoint_method_top20"] = top_k(
        pairs.select("endpoint", "method", F.col("n").alias("requests")), 20, ["requests"], ["endpoint", "method"]
    )
    triples = errors.select(*ERROR_PATTERN_KEYS, F.col("n").alias("frequency"))
    out["error_patterns"] = top_k(supported(triples, 2, fallback=True), 8, ["frequency"], list(ERROR_PATTERN_KEYS))
    unique_servers = _set(cube, "server_em").filter(F.col("em_ok") & F.col("server").isNotNull()).agg(F.count("*"))
    out["pattern_statistics"] = good_pairs.agg(
        F.count_distinct("endpoint").alias("unique_endpoints"),
        F.count_distinct("method").alias("unique_methods"),
        F.count("*").alias("unique_combinations"),
    ).withColumn("unique_servers", unique_servers.scalar())
    per_server = server_rows.filter(F.col("server").isNotNull()).groupBy("server").agg(
        F.sum(F.when(F.col("part") == "server", F.col("n"))).alias("requests"),
        F.count_if((F.col("part") == "server_endpoint") & F.col("endpoint").isNotNull()).alias("unique_endpoints"),
        F.count_if((F.col("part") == "server_method") & F.col("method").isNotNull()).alias("unique_methods"),
    )
    out["server_activity"] = top_k(per_server, 5, ["requests"], ["server"])
    kpi_rows = cube.select(F.col("part").alias("gid"), "endpoint", "server", "n", "errors", F.round("rt_avg", 2).alias("avg_ms"))
    out["kpi_summary"] = kpi_from_groups(kpi_rows, "endpoint", "server", "all")
    return out


# The direct analysis each one-scan result equals (same name, columns and rows).
DIRECT_EQUIVALENTS = {
    "level_distribution": ops.level_distribution,
    "level_counts": ops.level_counts,
    "top_endpoints": ops.top_endpoints,
    "error_analysis": ops.error_analysis,
    "error_count": ops.error_count,
    "server_performance": ops.server_performance,
    "server_requests_avg": ops.server_requests_avg,
    "server_key_counts": ops.server_key_counts,
    "hourly_traffic": ops.hourly_traffic,
    "hour_counts": ops.hour_counts,
    "daily_traffic": ops.daily_traffic,
    "ip_frequency": ops.ip_frequency,
    "null_counts": ops.null_counts,
    "unique_endpoints": ops.unique_endpoints,
    "distinct_endpoints": ops.distinct_endpoints,
    "simple_count": ops.simple_count,
    "endpoint_method_pairs": ops.frequent_pairs_with_fallback,
    "endpoint_method_top20": ops.endpoint_method_top,
    "error_patterns": ops.error_patterns_with_fallback,
    "pattern_statistics": ops.pattern_statistics,
    "server_activity": ops.server_activity,
    "kpi_summary": ops.kpi_summary,
    "user_activity": ops.user_activity,
    "session_patterns": ops.session_patterns,
}


def analyze_one_by_one(logs: DataFrame) -> dict[str, DataFrame]:
    """The same results as :func:`analyze_in_one_scan`, each planned on its own."""
    return {name: fn(logs) for name, fn in DIRECT_EQUIVALENTS.items()}


def analyze_in_one_scan(spark: SparkSession, logs: DataFrame, error_from: int = ERROR_FROM) -> dict[str, DataFrame]:
    """All report results with one scan for the small-domain ones.

    Writes the base groups (one job over the logs) and the cube, and returns
    lazy results: the derived ones plus the user and session reports, which read
    the logs themselves.
    """
    base = materialize(spark, base_groups(logs, error_from), "report-base")
    cube = materialize(spark, report_cube(base), "report-cube")
    results = derive(cube, error_from)
    results["user_activity"] = ops.user_activity(logs)
    results["session_patterns"] = ops.session_patterns(logs)
    return results
