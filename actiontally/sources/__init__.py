"""Sources and sinks: the event lake, the aggregate change log, topic and JDBC adapters."""

from actiontally.sources.changelog import (
    changes_since, covered, has_history, read_changes, read_current, remove_covered, user_splits, versions, write_changes,
)
from actiontally.sources.lake import lake_scan, read_lake, read_landed, write_lake
from actiontally.sources.slot_files import pack_slots, slot_files

__all__ = ["changes_since", "covered", "has_history", "read_changes", "read_current", "remove_covered",
           "user_splits", "versions", "write_changes", "lake_scan", "read_lake", "read_landed", "write_lake",
           "pack_slots", "slot_files"]
