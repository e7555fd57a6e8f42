"""Writers: landing zones for raw logs and result outputs."""

from .landing import land_lines, land_partitioned, land_raw, save_result_csv, save_results, to_raw

__all__ = ["land_lines", "land_partitioned", "land_raw", "save_result_csv", "save_results", "to_raw"]
