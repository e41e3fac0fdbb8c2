"""Streaming: postings as they land, and those that should have landed."""

from .deliveries import expect, expected_units, landed_units, late_units, watch_deliveries
from .ingest import ingest, refresh

__all__ = ["expect", "expected_units", "ingest", "landed_units", "late_units", "refresh", "watch_deliveries"]
