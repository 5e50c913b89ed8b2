"""Raw logs and stored tables: reading, writing, compaction, missing days."""

from eventmart.sources.files import exists, shared_folder
from eventmart.sources.lake import (
    add_tier1,
    relayout,
    write_sorted,
    write_tier1,
    write_tier2,
)
from eventmart.sources.ledger import Ledger, raw_files
from eventmart.sources.manifest import Manifest, Stamps, other_partitions, stale
from eventmart.sources.raw import delivered_days, read_raw, read_raw_paths
from eventmart.sources.tiers import calendar, missing_days, read_dates, read_quarantine, read_runs, read_tier

__all__ = [
    "Ledger", "Manifest", "Stamps", "add_tier1", "calendar", "delivered_days", "exists", "missing_days", "other_partitions", "raw_files",
    "read_dates", "read_quarantine", "read_raw", "read_raw_paths", "read_runs", "read_tier", "relayout", "shared_folder", "stale", "write_sorted", "write_tier1", "write_tier2",
]
