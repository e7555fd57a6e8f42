"""Summarize the final physical plan of every registered query.

python -m tests.plan_report [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

from tests.conftest import make_spark


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" :|"))


def strip_initial_plans(plan: str) -> str:
    """Drop every ``== Initial Plan ==`` section (also those of nested subqueries)."""
    out, skip_below = [], None
    for line in plan.splitlines():
        if skip_below is not None:
            if _indent(line) > skip_below:
                continue
            skip_below = None
        if "== Initial Plan ==" in line:
            skip_below = _indent(line)
            continue
        out.append(line)
    return "\n".join(out)


def final_plan(df) -> str:
    """Run ``df`` itself, so its adaptive plan is final, and return that plan."""
    df.collect()
    return strip_initial_plans(df._jdf.queryExecution().executedPlan().toString())


def summarize(plan: str) -> dict[str, str]:
    own = "\n".join(line for line in plan.splitlines() if "ReusedExchange" not in line)
    exchanges = re.findall(r"(?<!Reused)Exchange (hashpartitioning\(([^)]*)\)|SinglePartition|rangepartitioning\([^)]*\)|RoundRobinPartitioning\(\d+\))", own)
    kinds = []
    for full, keys in exchanges:
        if full.startswith("hash"):
            cols = [re.sub(r"#\d+L?", "", k.strip()) for k in keys.split(",")[:-1]]
            kinds.append("hash(" + ", ".join(cols) + ")")
        elif full.startswith("range"):
            kinds.append("range")
        elif full.startswith("RoundRobin"):
            kinds.append("round-robin")
        else:
            kinds.append("single (partials)")
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*?>)(?=\s|$)", plan)))
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p})
    part = sorted({p for p in re.findall(r"PartitionFilters: \[([^\]]*)\]", plan) if p})
    special = [op for op in ("TakeOrderedAndProject", "Expand", "Subquery", "Window", "BroadcastExchange", "CartesianProduct") if op in plan]
    return {
        "scans": str(len(re.findall(r"(?:FileScan|Scan) (?:parquet|json|csv|text|binaryFile)", plan))),
        "exchanges": "; ".join(kinds) or "none",
        "reused": str(plan.count("ReusedExchange")),
        "special": ", ".join(special) or "-",
        "read": " / ".join(schemas),
        "pushed": " / ".join(pushed + [f"partition: {p}" for p in part]) or "-",
    }


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from loglens.plans.catalog import all_queries

    spark = make_spark()
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    print("# Physical plans\n")
    print(f"Final adaptive plans of every registered log query at `{sf_dir}` on local[8], produced by")
    print("`python -m tests.plan_report`. *Exchanges* lists each shuffle with its partitioning;")
    print("`single (partials)` moves only one partial-aggregate row per task. *Reused* counts")
    print("shuffles shared with a scalar subquery instead of recomputed. `range` is the")
    print("range shuffle of a full `ORDER BY` over an already aggregated (small) result.\n")
    print("| Query | Scans | Exchanges | Reused | Notable operators | Read schema | Pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for key, query in all_queries().items():
        s = summarize(final_plan(query(spark, sf_dir)))
        read = s["read"].replace("|", "\\|")
        print(f"| `{key}` | {s['scans']} | {s['exchanges']} | {s['reused']} | {s['special']} | `{read}` | {s['pushed']} |")
    print(NOTES)

    from loglens.plans.one_scan import report_cube
    from loglens.sources.log_table import log_table

    s = summarize(final_plan(report_cube(log_table(spark, sf_dir))))
    print("## The one-scan report\n")
    print("`plans.one_scan.report_cube`: the grouping-sets aggregate that the whole small-domain")
    print("report derives from (13 grouping sets, written once; each result then reads it).\n")
    print("| Plan | Scans | Exchanges | Notable operators | Read schema |")
    print("| --- | --- | --- | --- | --- |")
    print(f"| `report_cube` | {s['scans']} | {s['exchanges']} | {s['special']} | `{s['read']}` |")
    return 0


NOTES = """
## Reading the table at 100 TB

* Every aggregation shuffles partial aggregates, never raw rows: the
  `hash(...)` exchanges sit after a map-side `HashAggregate`, and
  `single (partials)` moves one row per task. A key holding a third of
  all rows therefore costs one partial row per task.
* Distinct counts per group shuffle first on (key, value[, gid]) and then on the
  key (`server_activity`, `pattern_statistics`, and the second pass of
  `user_activity` / `session_patterns`), so a hot key is spread over many tasks
  in the first step.
* `user_activity` and `session_patterns` rank all keys with a single-level
  aggregate first. The `BroadcastExchange` then ships only the k winning rows
  (their size is known from the limit) to select the winners' rows inside the scan
  stage. `heavy_*` broadcast the candidates of a sketch (fewer than a third of its
  counters) and group their rows alone; `bucketed_*` group by user and session
  without an exchange. No plan has a cartesian product; a window appears only in
  `sql_functions`, over the rows that a top-k of 10,000 has kept.
* A share of all logs after a filter (`error_analysis`, the pair percentages) is taken
  from the same grouped shuffle, and so is the fallback's `MAX(frequency)` subquery:
  one scan each.
* `daily_report`, `daily_range` and `distinct_range` read the groups kept per day, never the log table.
* Top-k queries end in `TakeOrderedAndProject` (k rows per task), not in a
  full sort. A full `ORDER BY` (`range`) is used only on results bounded by a
  small key domain (levels, status codes, hours, days, servers).
* Read schemas show column pruning on the Parquet log table. Filters on
  stored columns are pushed into the scan. `partition_day` prunes
  directories (`PartitionFilters`) before any file is opened.
"""


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
