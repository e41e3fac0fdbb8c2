"""Whole runs made of the operators."""

from .attributes import stored_attributes, update_attributes
from .jobs import (
    Tables,
    discover_locations,
    land,
    rebuild_slices,
    run_daily,
    run_day,
    run_historic,
    run_range,
)
from .replay import failed_worklist, replay_failed

__all__ = [
    "stored_attributes", "update_attributes",
    "Tables", "discover_locations", "failed_worklist", "land", "rebuild_slices",
    "replay_failed", "run_daily", "run_day", "run_historic", "run_range",
]
