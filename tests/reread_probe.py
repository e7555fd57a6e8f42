"""Compare the benchmark workload under two designs (not part of pytest).

python -m tests.reread_probe [sf_dir] [copies]

* re-read: every query reads the raw JSON Lines again with schema inference
  into a temp view and runs as SQL text, the way a plain script over a raw
  zone works;
* loglens: the same JSON is parsed once into a Parquet log table (timed on
  its own) and the analyses read that.

``copies`` > 1 lands that many copies of the log view (shifted ids) to show
how the two grow with the data.

Both force full results through the ``noop`` sink (a ``count()`` would let
Spark drop sorts and averages). Prints one JSON line with the timings.
"""

from __future__ import annotations

import json
import sys
import time

from tests.conftest import make_spark

# The six benchmark queries as SQL over a view ``logs`` of raw records.
REREAD_SQL = {
    "simple_count": "SELECT COUNT(*) AS count FROM logs",
    "level_counts": "SELECT level, COUNT(*) AS count FROM logs GROUP BY level",
    "error_count": "SELECT COUNT(*) AS count FROM logs WHERE status_code >= 400",
    "server_requests_avg": (
        "SELECT server, COUNT(*) AS requests, AVG(response_time) AS avg_time FROM logs "
        "GROUP BY server ORDER BY requests DESC"
    ),
    "hour_counts": (
        "SELECT HOUR(CAST(timestamp AS TIMESTAMP_NTZ)) AS hour, COUNT(*) AS requests FROM logs "
        "GROUP BY 1 ORDER BY hour"
    ),
    "endpoint_method_top20": (
        "SELECT endpoint, method, COUNT(*) AS requests FROM logs GROUP BY endpoint, method "
        "ORDER BY requests DESC LIMIT 20"
    ),
}


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    copies = int(argv[1]) if len(argv) > 1 else 1
    import functools

    from pyspark.sql import functions as F

    from loglens import operators as ops
    from loglens.session import fresh_path
    from loglens.sinks.landing import land_raw
    from loglens.sources.fixture import logs_from_events
    from loglens.sources.json_logs import read_json_logs
    from loglens.sources.log_table import materialize

    spark = make_spark()
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    shifted = [events.withColumn("event_id", F.col("event_id") + i * 1_000_000) for i in range(copies)]
    logs = logs_from_events(functools.reduce(lambda a, b: a.unionByName(b), shifted).repartition(8 * copies))
    raw = land_raw(logs.drop("event_id"), fresh_path(spark, "reread-raw"))
    analyses = {
        "simple_count": ops.simple_count,
        "level_counts": ops.level_counts,
        "error_count": ops.error_count,
        "server_requests_avg": ops.server_requests_avg,
        "hour_counts": ops.hour_counts,
        "endpoint_method_top20": ops.endpoint_method_top,
    }

    def force(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    def reread(sql: str) -> None:
        spark.read.json(raw).createOrReplaceTempView("logs")
        force(spark.sql(sql))

    def best(fn, n: int = 3) -> float:
        out = []
        for _ in range(n):
            t0 = time.perf_counter()
            fn()
            out.append(time.perf_counter() - t0)
        return min(out)

    force(spark.read.json(raw))  # warm up the JVM on an untimed job
    t0 = time.perf_counter()
    table = materialize(spark, read_json_logs(spark, raw), "reread-table")
    build = time.perf_counter() - t0
    result = {"rows": table.count(), "reread": {}, "loglens": {}, "loglens_log_table_build": round(build, 3)}
    for key, sql in REREAD_SQL.items():
        result["reread"][key] = round(best(lambda sql=sql: reread(sql)), 3)
        result["loglens"][key] = round(best(lambda key=key: force(analyses[key](table))), 3)
    result["reread_total"] = round(sum(result["reread"].values()), 3)
    result["loglens_total"] = round(sum(result["loglens"].values()), 3)
    print(json.dumps(result))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
