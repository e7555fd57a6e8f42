"""Readers: log files, saved results, file inventory, and the log view over ``events``."""

from .fixture import load_logs, logs_from_events
from .json_logs import (
    parse_timestamp,
    read_json_logs,
    read_partitioned_logs,
    read_partitioned_with_rejects,
    read_with_rejects,
    reject_summary,
    split_rejects,
)
from .log_table import log_table, materialize, read_log_table, store_logs
from .results import file_inventory, read_result_csv, zone_status, zone_usage

__all__ = [
    "file_inventory",
    "load_logs",
    "log_table",
    "logs_from_events",
    "materialize",
    "parse_timestamp",
    "read_json_logs",
    "read_log_table",
    "read_partitioned_logs",
    "read_partitioned_with_rejects",
    "read_result_csv",
    "read_with_rejects",
    "reject_summary",
    "split_rejects",
    "store_logs",
    "zone_status",
    "zone_usage",
]
