"""Incremental processing of newly landed log files."""

from .ingest import ingest, ingest_summary, marked_log_stream, read_ingest_rejects, read_ingested

__all__ = ["ingest", "ingest_summary", "marked_log_stream", "read_ingest_rejects", "read_ingested"]
