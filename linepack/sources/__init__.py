"""Sources: posted files, reference tables and the failure log."""

from .failures import append_failures, failed_units, read_failures
from .landing import literal_path, posted_files
from .postings import (
    SegmentFiles,
    inspect_segments,
    profile,
    read_meta,
    read_points,
    read_segments,
    unreadable_segments,
)
from .references import loc_reference, pipe_reference, pipe_rejects, stored_meta

__all__ = [
    "SegmentFiles", "append_failures", "failed_units", "inspect_segments", "literal_path", "loc_reference",
    "pipe_reference", "pipe_rejects", "posted_files", "profile", "read_failures", "read_meta", "read_points", "read_segments",
    "stored_meta", "unreadable_segments",
]
