"""Landing zones for raw logs and writers for analysis results."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import LOG_FIELDS
from .packing import FILE_BYTES, write_packed

# Text form of a timestamp in a log line: ISO-8601 UTC with microseconds.
TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
# Timestamps without zone in CSV results, microseconds kept (the default drops them).
CSV_TIMESTAMP_NTZ = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def to_raw(logs: DataFrame) -> DataFrame:
    """Typed logs -> the text form written to log files (timestamp as ISO text)."""
    return logs.withColumn("timestamp", F.date_format("timestamp", TIMESTAMP_TEXT))


def land_raw(logs: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None) -> str:
    """Write typed logs as JSON Lines under ``path`` (one file per task).

    Uncompressed by default: a reader can split large files across tasks.
    ``compression`` (e.g. ``"gzip"``) makes smaller files that are each read
    by a single task; ``"bzip2"`` stays splittable.
    """
    writer = to_raw(logs).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)
    return path


def land_partitioned(
    logs: DataFrame, base: str, cluster: bool = True, max_records_per_file: int = 0, file_bytes: int = FILE_BYTES
) -> str:
    """Write typed logs as JSON Lines in ``base/date=YYYY-MM-DD/``.

    Re-landing replaces only the dates present in ``logs`` (dynamic partition
    overwrite). Rows are packed by date (:mod:`.packing`): about one file per date and
    ``file_bytes``, in time order inside a file; a very busy day is split over several
    tasks. With ``cluster=False`` there is no shuffle and each task writes the dates it
    holds; use it for input in time order (one or two dates per task), as
    unordered input would leave up to tasks x dates small files.
    ``max_records_per_file`` bounds file size by rows.
    """
    df = to_raw(logs.withColumn("date", F.to_date("timestamp")))
    options = {"partitionOverwriteMode": "dynamic"}
    if max_records_per_file:
        options["maxRecordsPerFile"] = str(max_records_per_file)
    if cluster:
        return write_packed(df, base, ["date"], file_bytes, ["timestamp"], "json", "overwrite", options)
    df.write.mode("overwrite").options(**options).partitionBy("date").json(base)
    return base


def land_lines(lines: DataFrame, path: str, column: str = "value") -> str:
    """Write one text line per row (already formatted log lines)."""
    lines.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
    return path


def save_result_csv(
    result: DataFrame,
    path: str,
    single_file: bool = False,
    null_value: str | None = None,
    order_by: Sequence[Column] = (),
) -> str:
    """Write a result as CSV with a header, replacing ``path``.

    ``single_file`` writes one file from one task; ask for it only for bounded
    results such as a top-k or a per-hour table, never for a result that grows
    with the input. Its rows are in the order of ``order_by``, sorted inside the
    one partition: merging sorted partitions does not promise their order.

    By default NULL is written as an empty field, as most CSV readers expect;
    read back, an empty string then also becomes NULL. Pass a marker such as
    ``null_value="\\N"`` (to both this and the reader) to keep the two apart.
    """
    out = result.coalesce(1) if single_file else result
    if single_file and order_by:
        out = out.sortWithinPartitions(*order_by)
    writer = (
        out.write.mode("overwrite")
        .option("header", True)
        .option("timestampNTZFormat", CSV_TIMESTAMP_NTZ)
        # keep values as they are (the writer trims surrounding blanks by default)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    writer.csv(path)
    return path


def root_cause(exc: BaseException) -> str:
    """The innermost cause of ``exc``, of Python's or the JVM's, whole."""
    while exc.__cause__ is not None:
        exc = exc.__cause__
    java = getattr(exc, "java_exception", None)
    if java is None:
        return f"{type(exc).__name__}: {exc}"
    while java.getCause() is not None:
        java = java.getCause()
    return java.toString()


class SaveError(RuntimeError):
    """Some results could not be saved; ``status`` has the outcome of each."""

    def __init__(self, status: Mapping[str, str]):
        self.status = dict(status)
        failed = [f"{name}: {text}" for name, text in status.items() if text != "ok"]
        super().__init__(f"{len(failed)} of {len(status)} results failed\n" + "\n".join(failed))


def save_results(
    results: Mapping[str, DataFrame],
    base: str,
    single_file: Collection[str] = (),
    orders: Mapping[str, Sequence[Column]] | None = None,
) -> dict[str, str]:
    """Save every named result under ``base/<name>``; returns ``name -> "ok" | "failed: <root cause>"``.

    Results named in ``single_file`` (bounded ones) are written as one file
    each, in the order that ``orders`` gives. One failing result does not stop
    the others, and each outcome is reported with its underlying cause.
    """
    status: dict[str, str] = {}
    for name, frame in results.items():
        try:
            order = (orders or {}).get(name, ())
            save_result_csv(frame, f"{base.rstrip('/')}/{name}", single_file=name in single_file, order_by=order)
            status[name] = "ok"
        except Exception as exc:  # report per result, keep going
            status[name] = f"failed: {root_cause(exc)}"
    return status


__all__ = [
    "CSV_TIMESTAMP_NTZ",
    "LOG_FIELDS",
    "SaveError",
    "TIMESTAMP_TEXT",
    "land_lines",
    "land_partitioned",
    "land_raw",
    "root_cause",
    "save_result_csv",
    "save_results",
    "to_raw",
]
