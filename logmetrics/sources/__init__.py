"""Scans of log trees, parquet tables and earlier results."""

from .drift import drift_report, inexact_values, read_drifting
from .inventory import file_inventory, inventory_summary, largest_applications
from .logs import LOG_FILES, read_logs, with_ids
from .tables import (
    describe_source,
    existing_paths,
    load_result,
    month_paths,
    read_months,
    read_trips,
    register_views,
    source_sample,
    union_all,
)

__all__ = [
    "LOG_FILES", "describe_source", "drift_report", "existing_paths", "file_inventory", "inexact_values", "inventory_summary",
    "largest_applications", "load_result", "month_paths", "read_logs",
    "read_drifting", "read_months", "read_trips", "register_views", "source_sample", "union_all", "with_ids",
]
