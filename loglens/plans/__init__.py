"""Query catalog, SQL views, the whole report, and the independent SQL oracle."""

from .one_scan import analyze_in_one_scan, analyze_one_by_one, base_groups, report_cube
from .report import analyze, run_report, save_report
from .views import register_analyses, register_views

__all__ = [
    "analyze",
    "analyze_in_one_scan",
    "analyze_one_by_one",
    "base_groups",
    "register_analyses",
    "register_views",
    "report_cube",
    "run_report",
    "save_report",
]
