"""Operators from DataFrame to DataFrame."""

from .audit import (
    Reports,
    counts_of_files,
    dataset_detail,
    failures,
    file_counts,
    missing_downloads,
    new_location_counts,
    offered_units,
    pipe_changes,
    raw_counts,
    reports,
    run_summary,
    silver_counts,
)
from .calendar import daily_range, expand_days, historic_range
from .current import current_postings, newest_postings, of_files
from .cycles import cycle_counts, latest_cycle
from .gold import gold_nn, gold_oa, gold_sg, merge_gold, sg_directions, with_gas_day
from .locations import (
    existing_numbers,
    keyed,
    new_point_locations,
    new_segment_locations,
    upsert_by_key,
)
from .metadata import meta_changes, meta_enrichment
from .numbering import running_number
from .rejects import (
    all_rejects,
    point_rejects,
    segment_rejects,
    silver_rejects,
    unmatched_stations,
)
from .shape import (
    all_text,
    alphanumeric_names,
    conform,
    drop_all_null,
    select_present,
    union_by_name,
    with_missing_as_empty,
)
from .silver import pipes_of, point_silver, segment_silver
from .validate import rejected, valid, validate_pipes, validate_results

__all__ = [
    "cycle_counts", "latest_cycle",
    "current_postings", "newest_postings", "of_files",
    "Reports", "reports",
    "all_rejects", "all_text", "alphanumeric_names", "conform", "counts_of_files", "daily_range",
    "dataset_detail", "drop_all_null", "existing_numbers", "expand_days", "failures",
    "file_counts", "gold_nn", "gold_oa", "gold_sg", "historic_range", "keyed",
    "merge_gold", "meta_changes", "meta_enrichment", "missing_downloads",
    "new_location_counts", "new_point_locations", "new_segment_locations", "offered_units",
    "pipe_changes", "pipes_of", "point_rejects", "point_silver", "raw_counts",
    "rejected", "run_summary", "running_number", "segment_rejects", "segment_silver",
    "select_present", "sg_directions", "silver_counts", "silver_rejects",
    "union_by_name", "unmatched_stations", "upsert_by_key", "valid", "validate_pipes",
    "validate_results", "with_gas_day", "with_missing_as_empty",
]
