"""Tumbling event-time windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tumbling_window(time_col: str, duration: str) -> Column:
    """Window struct (start, end); end is exclusive.  Works for batch and streaming input."""
    return F.window(F.col(time_col), duration)


def window_bounds(window_col: str = "window") -> list[Column]:
    """Window edges as TIMESTAMP_NTZ (streams carry TIMESTAMP for the watermark)."""
    return [F.col(f"{window_col}.start").cast("timestamp_ntz").alias("window_start"),
            F.col(f"{window_col}.end").cast("timestamp_ntz").alias("window_end")]
