"""actiontally: user-action analytics on Spark.

Decodes JSON action events, lands them in a Parquet lake laid out by date, two-hour
slot and user bucket, and counts each user's actions in event-time windows.  Results
go to a versioned aggregate table in which the newest version of each key wins.
The same DataFrame functions serve Structured Streaming and batch backfill.
"""

from actiontally.session import build_session, scratch_path, pin_utc

__all__ = ["build_session", "scratch_path", "pin_utc"]
