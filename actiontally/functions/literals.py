"""Zone-free time literals (a Python datetime literal would pass through the local zone)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_datetime(v: str | dt.datetime | dt.date) -> dt.datetime:
    if isinstance(v, str):
        return dt.datetime.fromisoformat(v)
    if isinstance(v, dt.datetime):
        return v
    return dt.datetime(v.year, v.month, v.day)


def ntz(v: str | dt.datetime | dt.date) -> Column:
    return F.lit(as_datetime(v).isoformat(sep=" ")).cast("timestamp_ntz")


def day(v: dt.date) -> Column:
    return F.lit(v.isoformat()).cast("date")
