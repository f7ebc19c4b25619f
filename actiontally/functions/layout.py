"""Lake partition columns and the month partition of aggregate rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Lake layout levels and bucket count.
N_BUCKETS = 128
SLOT_HOURS = 2
PARTITION_COLUMNS = ["event_date", "event_hour"]


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def event_date(time_col: str | Column) -> Column:
    return F.to_date(_c(time_col))


def event_hour(time_col: str | Column) -> Column:
    """Start hour of the two-hour slot: 0, 2, ..., 22."""
    h = F.hour(_c(time_col))
    return (h - h % F.lit(SLOT_HOURS)).cast("int")


def user_bucket(user_col: str | Column, n: int = N_BUCKETS) -> Column:
    return F.pmod(_c(user_col), F.lit(n)).cast("int")


def yyyymm(time_col: str | Column) -> Column:
    c = _c(time_col)
    return (F.year(c) * 100 + F.month(c)).cast("int")


def with_partition_columns(df: DataFrame, time_col: str = "event_time", user_col: str = "user_id",
                           n_buckets: int = N_BUCKETS) -> DataFrame:
    return df.withColumns({
        "event_date": event_date(time_col),
        "event_hour": event_hour(time_col),
        "bucket": user_bucket(user_col, n_buckets),
    })
