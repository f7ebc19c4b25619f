"""Relational operators: windowed counts, version collapse, lookups, expiry, compaction."""

from actiontally.operators.aggregates import user_action_counts, user_aggregations
from actiontally.operators.backfill import backfill_aggregations, backfill_to_table
from actiontally.operators.versions import (
    compact, compact_table, current_rows, expire_before, latest_versions, lookup_aggregates, month_summary,
)

__all__ = [
    "user_action_counts", "user_aggregations", "backfill_aggregations", "backfill_to_table", "compact", "compact_table", "current_rows", "expire_before",
    "latest_versions", "lookup_aggregates", "month_summary",
]
