"""Sinks: bronze, silver, gold and versioned reference tables."""

from .bronze import bronze_location, bronze_period, read_bronze, read_bronze_run, read_bronze_runs, write_bronze
from .gold import (
    cluster_months,
    gold_exists,
    merge_slices,
    read_gold,
    replace_slices,
    touched_slices,
)
from .ledger import (
    any_entered,
    current_files,
    days_of_files,
    enter_days,
    enter_files,
    enter_rebuilt,
    enter_waiting,
    left_days,
    new_files,
    posting_days,
    waiting_days,
)
from .silver import read_silver, write_silver
from .versions import read_version, write_version

__all__ = [
    "any_entered", "bronze_location", "bronze_period", "cluster_months", "current_files", "days_of_files", "enter_days",
    "enter_files", "enter_rebuilt", "enter_waiting", "gold_exists", "left_days", "merge_slices", "new_files", "posting_days", "read_bronze",
    "read_bronze_run", "read_bronze_runs", "read_gold", "read_silver", "read_version", "replace_slices", "touched_slices",
    "waiting_days", "write_bronze", "write_silver", "write_version",
]
