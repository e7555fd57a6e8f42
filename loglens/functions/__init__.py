"""Column-level helpers shared by the analyses."""

from .columns import (
    ERROR_FROM,
    error_flag_count,
    is_error,
    mean_of,
    percent,
    scalar_max,
    scalar_total,
    with_time_columns,
)
from .ranking import ordering, sort_rows, top_k

__all__ = [
    "ERROR_FROM",
    "error_flag_count",
    "is_error",
    "mean_of",
    "ordering",
    "percent",
    "scalar_max",
    "scalar_total",
    "sort_rows",
    "top_k",
    "with_time_columns",
]
