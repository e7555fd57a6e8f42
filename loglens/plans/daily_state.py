"""The whole report kept up to date by day.

Every result of the report is a function of partial groups that add up over days.
:class:`DailyState` keeps these groups per day in the shared folder:

* ``base``: the base groups of the one-scan report (:mod:`.one_scan`), with their day;
* ``sessions``: rows, times and response times per (session, user);
* ``pages``: the different (session, user, endpoint) triples;
* ``bitmaps``: sets of values as bitmaps over dictionary ids, exact and mergeable by OR.

``refresh`` recomputes only the days it is given (with a log table partitioned by
date, only their files are read) and commits a new version that names, for each day, the write
that holds it. A day that lands again replaces its former groups, also by nothing. ``results`` merges the
groups of any range of days into all results of the report without touching a log row.
A failed refresh leaves the last version, and readers of a version keep their files.

Distinct counts don't add up, sets do. Each counted value has an id in a dictionary that only grows; a
day's values of a metric are the bits of their ids, in rows of Spark's 32,768-bit buckets
(``bitmap_construct_agg``). A range of days ORs them (``bitmap_or_agg``) and counts bits: exact,
and the work depends on days, metrics and dictionary, not on rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ERROR_FROM, error_flag_count, mean_of, with_time_columns
from ..functions.numbering import number_rows
from ..functions.ranking import rows_of_top, top_k
from ..operators.users import SESSION_COLUMNS, USER_COLUMNS
from ..sinks.manifest import commit_version, latest_version, read_version
from ..sources.log_table import materialize
from .one_scan import BASE_COLUMNS, BASE_SETS, derive, report_cube

# The day of rows without a timestamp.
NO_DAY = "none"
DAY = "day"

_GROUPS = "gid long, n long, errors long, rt_sum long, rt_count long, rt_max long"
SCHEMAS = {
    "base": "level string, endpoint string, method string, server string, status_code long, date date, hour int, "
    f"ip_address string, {_GROUPS}",
    "sessions": "session_id string, user_id string, n long, rt_sum long, rt_count long, first timestamp_ntz, last timestamp_ntz",
    "pages": "session_id string, user_id string, endpoint string",
    "bitmaps": "metric string, key string, bucket long, bits binary, has_null boolean",
}
DICTIONARY = "domain string, value string, id long"


def day_of(timestamp: str | Column = "timestamp") -> Column:
    """The day of a timestamp as text."""
    return F.coalesce(F.date_format(timestamp, "yyyy-MM-dd"), F.lit(NO_DAY))


def _day_text(day: str | dt.date | None) -> str:
    return NO_DAY if day is None else day if isinstance(day, str) else day.isoformat()


def daily_base(logs: DataFrame, error_from: int = ERROR_FROM) -> DataFrame:
    """The base groups of :func:`.one_scan.base_groups` per day, from one scan."""
    sets = [[DAY, *cols] for cols in BASE_SETS.values()]
    columns = [DAY, *BASE_COLUMNS]
    groups = with_time_columns(logs.withColumn(DAY, day_of())).groupingSets(sets, *columns).agg(
        F.grouping_id(*columns).alias("gid"),  # the day, always grouped, is its highest bit
        F.count("*").alias("n"),
        error_flag_count("status_code", error_from).alias("errors"),
        F.sum("response_time").alias("rt_sum"),
        F.count("response_time").alias("rt_count"),
        F.max("response_time").alias("rt_max"),
    )
    return groups


def daily_sessions(logs: DataFrame) -> DataFrame:
    """Rows, response times and first and last event per day, session and user."""
    return logs.groupBy(day_of().alias(DAY), "session_id", "user_id").agg(
        F.count("*").alias("n"),
        F.sum("response_time").alias("rt_sum"),
        F.count("response_time").alias("rt_count"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )


def daily_pages(logs: DataFrame) -> DataFrame:
    """The different endpoints per day, session and user (those of neither are not needed)."""
    named = F.col("endpoint").isNotNull() & (F.col("session_id").isNotNull() | F.col("user_id").isNotNull())
    return logs.filter(named).select(day_of().alias(DAY), "session_id", "user_id", "endpoint").distinct()


# Metric -> domain of its values, value, key of its groups, rows that count. A NULL value is noted, not numbered.
METRICS: dict[str, tuple[str, str, str | None, str]] = {
    "endpoints": ("endpoint", "endpoint", None, "true"),
    "pair_endpoints": ("endpoint", "endpoint", None, "endpoint IS NOT NULL AND method IS NOT NULL"),
    "pair_methods": ("method", "method", None, "endpoint IS NOT NULL AND method IS NOT NULL"),
    "pair_servers": ("server", "server", None, "endpoint IS NOT NULL AND method IS NOT NULL"),
    "pairs": ("pair", "to_json(struct(endpoint, method))", None, "endpoint IS NOT NULL AND method IS NOT NULL"),
    "server_endpoints": ("endpoint", "endpoint", "server", "server IS NOT NULL"),
    "server_methods": ("method", "method", "server", "server IS NOT NULL"),
}


def metric_values(base: DataFrame) -> DataFrame:
    """``day, metric, domain, key, value`` of all counted values, from the day's joint base groups."""
    joint = base.filter(F.col("gid") == joint_gid())
    cells = joint.select(DAY, "endpoint", "method", "server").distinct()
    each = [
        F.struct(F.lit(m).alias("metric"), F.lit(domain).alias("domain"), F.expr(key or "cast(NULL AS string)").alias("key"),
                 F.expr(value).alias("value"), F.expr(counts).alias("counts"))
        for m, (domain, value, key, counts) in METRICS.items()
    ]
    rows = cells.select(DAY, F.explode(F.array(*each)).alias("m")).filter("m.counts")
    return rows.select(DAY, "m.metric", "m.domain", "m.key", "m.value").distinct()


def joint_gid() -> int:
    """``grouping_id`` of the joint base set."""
    return sum(1 << (len(BASE_COLUMNS) - 1 - i) for i, c in enumerate(BASE_COLUMNS) if c not in BASE_SETS["joint"])


def count_bits(bitmaps: DataFrame) -> DataFrame:
    """``metric, key, count, has_null``: different values over all given days."""
    merged = bitmaps.groupBy("metric", "key", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.max("has_null").alias("has_null"))
    return merged.groupBy("metric", "key").agg(F.sum(F.bitmap_count("bits")).alias("count"), F.max("has_null").alias("has_null"))


class DailyState:
    """The state at ``path`` as of one version."""

    def __init__(self, spark: SparkSession, path: str, version: dict[str, Any]):
        self.spark, self.path, self.version = spark, path.rstrip("/"), version

    @classmethod
    def open(cls, spark: SparkSession, path: str, number: int | None = None) -> DailyState:
        """The latest version at ``path`` (an empty state if there is none), or version ``number``."""
        version = latest_version(spark, path) if number is None else read_version(spark, path, number)
        return cls(spark, path, version or {"number": 0, "days": {}, "dictionaries": [], "ids": {}})

    def days(self) -> list[str]:
        """The days that the state holds (also those without a row)."""
        return sorted(self.version["days"])

    def table(self, name: str, days: Iterable[str | dt.date | None] | None = None) -> DataFrame:
        """The groups of table ``name`` with their ``day``, of all or some days; only these days' files are listed."""
        schema = T.StructType.fromDDL(SCHEMAS[name]).add(DAY, T.StringType()).add("write", T.StringType())
        wanted = self.days() if days is None else [_day_text(d) for d in days]
        held = self.version["days"]
        folders = [f"{self.path}/{name}/{DAY}={d}/write={held[d]['write']}" for d in wanted if d in held and held[d]["rows"].get(name)]
        if not folders:
            return self.spark.createDataFrame([], schema).drop("write")
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name}").parquet(*folders).drop("write")

    def dictionary(self) -> DataFrame:
        """``domain, value, id`` of all values numbered so far."""
        folders = self.version["dictionaries"]
        schema = T.StructType.fromDDL(DICTIONARY)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _numbered(self, values: DataFrame, write: str) -> tuple[DataFrame, list[str], dict[str, int]]:
        """The dictionary with the new ``domain, value`` pairs, its folders and the last id of each domain."""
        new = values.filter("value IS NOT NULL").select("domain", "value").distinct()
        new = new.join(self.dictionary().select("domain", "value"), ["domain", "value"], "left_anti")
        ranked = number_rows(self.spark, new, [F.col("domain"), F.col("value")], "place")
        firsts = {r["domain"]: (r["first"], r["n"]) for r in ranked.groupBy("domain").agg(F.min("place").alias("first"), F.count("*").alias("n")).collect()}
        ids = dict(self.version["ids"])
        shift = F.lit(0)
        for domain, (first, n) in firsts.items():  # one per counted column
            shift = F.when(F.col("domain") == domain, F.lit(ids.get(domain, 0) - first + 1)).otherwise(shift)
            ids[domain] = ids.get(domain, 0) + n
        if not firsts:
            return self.dictionary(), self.version["dictionaries"], ids
        folder = f"{self.path}/dictionary/{write}"
        ranked.select("domain", "value", (F.col("place") + shift).cast("long").alias("id")).write.parquet(folder)
        folders = [*self.version["dictionaries"], folder]
        return self.spark.read.schema(T.StructType.fromDDL(DICTIONARY)).parquet(*folders), folders, ids

    def _bitmaps(self, values: DataFrame, dictionary: DataFrame) -> DataFrame:
        coded = values.join(dictionary, ["domain", "value"], "left")
        # a NULL value sets no bit: its row only carries has_null, in the first bucket
        at = F.coalesce("id", F.lit(1))
        bits = F.bitmap_construct_agg(F.when(F.col("id").isNotNull(), F.bitmap_bit_position("id")))
        groups = coded.groupBy(DAY, "metric", "key", F.bitmap_bucket_number(at).alias("bucket"))
        return groups.agg(bits.alias("bits"), F.max(F.col("value").isNull()).alias("has_null"))

    def refresh(self, logs: DataFrame, days: Sequence[str | dt.date | None] | None = None, error_from: int = ERROR_FROM) -> DailyState:
        """The state with the groups of ``days`` (all days of ``logs`` by default) as ``logs`` has them.

        Given ``days``, a log table partitioned by date reads only their files if ``logs`` is its scan
        for these dates; rows of other days are left out, and a day without rows is kept as empty.
        """
        if days is not None:
            logs = logs.filter(day_of().isin([_day_text(d) for d in days]))
        write = f"{self.version['number'] + 1:08d}-{uuid.uuid4().hex[:8]}"
        base = materialize(self.spark, daily_base(logs, error_from), "daily-base")
        values = materialize(self.spark, metric_values(base), "daily-values")
        dictionary, dictionaries, ids = self._numbered(values, write)
        tables = {"base": base, "sessions": daily_sessions(logs), "pages": daily_pages(logs), "bitmaps": self._bitmaps(values, dictionary)}
        held: dict[str, dict[str, int]] = {}
        for name, groups in tables.items():
            stored = T.StructType.fromDDL(SCHEMAS[name])
            columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in stored]
            out = groups.select(*columns, DAY, F.lit(write).alias("write"))
            # one directory per day; a day's groups come from one shuffle partition or, if large, several
            out.hint("rebalance", DAY).write.mode("append").partitionBy(DAY, "write").parquet(f"{self.path}/{name}")
            # a row per day
            found = self.spark.read.schema(T.StructType([*stored, T.StructField(DAY, T.StringType()), T.StructField("write", T.StringType())]))
            found = found.parquet(f"{self.path}/{name}").filter(F.col("write") == write).groupBy(DAY).agg(F.count("*").alias("n"))
            for r in found.collect():
                held.setdefault(r[DAY], {})[name] = r["n"]
        wanted = sorted(held) if days is None else [_day_text(d) for d in days]
        kept = {**self.version["days"], **{d: {"write": write, "rows": held.get(d, {})} for d in wanted}}
        number = self.version["number"] + 1
        version = {"number": number, "days": kept, "dictionaries": dictionaries, "ids": ids}
        commit_version(self.spark, self.path, number, version)
        return DailyState(self.spark, self.path, version)

    def distinct_counts(self, days: Iterable[str | dt.date | None] | None = None) -> DataFrame:
        """``metric, key, count, has_null``: exact distinct counts over all or some days, from the bitmaps alone."""
        return count_bits(self.table("bitmaps", days))

    def results(self, days: Iterable[str | dt.date | None] | None = None, error_from: int = ERROR_FROM) -> dict[str, DataFrame]:
        """All results of the report over all or some days, from the stored groups.

        Names and columns are those of :func:`.one_scan.analyze_in_one_scan`.
        """
        days = None if days is None else list(days)
        base = self.table("base", days).drop(DAY)
        cube = materialize(self.spark, report_cube(base), "daily-cube")
        out = derive(cube, error_from)
        counts = materialize(self.spark, self.distinct_counts(days), "daily-counts")
        out.update(self._distinct_results(cube, counts))
        sessions, pages = self.table("sessions", days), self.table("pages", days)
        out["user_activity"] = user_activity_of(sessions, pages)
        out["session_patterns"] = session_patterns_of(sessions, pages)
        return out

    def _distinct_results(self, cube: DataFrame, counts: DataFrame) -> dict[str, DataFrame]:
        count = lambda m: F.coalesce(F.max(F.when(F.col("metric") == m, F.col("count"))), F.lit(0)).cast("long")
        with_null = count("endpoints") + F.coalesce(F.max(F.when(F.col("metric") == "endpoints", F.col("has_null").cast("long"))), F.lit(0))
        statistics = {"unique_endpoints": "pair_endpoints", "unique_methods": "pair_methods", "unique_combinations": "pairs", "unique_servers": "pair_servers"}
        servers = cube.filter((F.col("part") == "server") & F.col("server").isNotNull()).select("server", F.col("n").alias("requests"))
        per_server = counts.filter(F.col("key").isNotNull()).groupBy(F.col("key").alias("server")).agg(
            count("server_endpoints").alias("unique_endpoints"), count("server_methods").alias("unique_methods")
        )
        return {
            "unique_endpoints": counts.agg(count("endpoints").alias("count")),
            "distinct_endpoints": counts.agg(with_null.alias("count")),
            "pattern_statistics": counts.agg(*[count(m).alias(c) for c, m in statistics.items()]),
            "server_activity": top_k(servers.join(per_server, "server"), 5, ["requests"], ["server"]),
        }


def user_activity_of(sessions: DataFrame, pages: DataFrame, k: int = 15) -> DataFrame:
    """:func:`loglens.operators.user_activity` from daily groups."""
    users = sessions.filter(F.col("user_id").isNotNull())
    mean = F.round(mean_of(F.sum("rt_sum"), F.sum("rt_count")), 2).alias("avg_response_time")
    order = {"desc": ["requests"], "asc": ["user_id"]}
    top = top_k(users.groupBy("user_id").agg(F.sum("n").alias("requests"), mean), k, **order)
    seen = rows_of_top(users.select("user_id", "session_id"), top.select("user_id"), ["user_id"])
    seen = seen.groupBy("user_id").agg(F.count_distinct("session_id").alias("sessions"))
    read = rows_of_top(pages.select("user_id", "endpoint"), top.select("user_id"), ["user_id"])
    read = read.groupBy("user_id").agg(F.count_distinct("endpoint").alias("unique_pages"))
    whole = top.join(seen, "user_id", "left").join(read, "user_id", "left")
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("sessions", "unique_pages")}
    return top_k(whole.withColumns(zero), k, **order).select(*USER_COLUMNS)


def session_patterns_of(sessions: DataFrame, pages: DataFrame, k: int = 10) -> DataFrame:
    """:func:`loglens.operators.session_patterns` from daily groups."""
    keys = ["session_id", "user_id"]
    rows = sessions.filter(F.col("session_id").isNotNull())
    order = {"desc": ["page_views"], "asc": keys}
    ranking = [F.sum("n").alias("page_views"), F.min("first").alias("session_start"), F.max("last").alias("session_end")]
    top = top_k(rows.groupBy(*keys).agg(*ranking), k, **order)
    read = rows_of_top(pages, top.select(*keys), keys).groupBy(*keys).agg(F.count_distinct("endpoint").alias("unique_pages"))
    renamed = read.select(F.col("session_id").alias("_s"), F.col("user_id").alias("_u"), "unique_pages")
    same = F.col("session_id").eqNullSafe(F.col("_s")) & F.col("user_id").eqNullSafe(F.col("_u"))
    whole = top.join(renamed, same, "left").withColumn("unique_pages", F.coalesce("unique_pages", F.lit(0)))
    return top_k(whole, k, **order).select(*SESSION_COLUMNS)
