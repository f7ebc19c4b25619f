"""Per-user action counts in tumbling event-time windows.

Both functions accept batch or streaming DataFrames.  Plans are a partial hash
aggregate before the shuffle and a final one after it, so a user with a large share
of all events costs one partial row per map task, never one task holding the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actiontally.functions.windows import tumbling_window, window_bounds
from actiontally.schemas import ACTION_TAG_PREFIX, NO_TYPE, TOTAL_TAG


def type_tag(type_col: str = "action_type") -> Column:
    """``aggregation_type`` of a per-type count; a record without a type is tagged ``action:(none)``."""
    return F.concat(F.lit(ACTION_TAG_PREFIX), F.coalesce(F.col(type_col), F.lit(NO_TYPE)))


def _actions(weight_col: str | None) -> Column:
    return (F.sum(weight_col) if weight_col else F.count(F.lit(1))).alias("total_actions")


def user_action_counts(events: DataFrame, duration: str = "2 hours", by_type: bool = False,
                       time_col: str = "event_time", user_col: str = "user_id",
                       type_col: str = "action_type", weight_col: str | None = None) -> DataFrame:
    """Actions per user (and per action type when ``by_type``) per window.  A row stands for
    ``weight_col`` actions (default: one).

    Columns: user_id, [action_type], window_start, window_end, total_actions.
    """
    keys = [F.col(user_col).alias("user_id")]
    if by_type:
        keys.append(F.col(type_col).alias("action_type"))
    agg = events.groupBy(*keys, tumbling_window(time_col, duration).alias("window")).agg(_actions(weight_col))
    return agg.select("user_id", *(["action_type"] if by_type else []), *window_bounds("window"),
                      "total_actions")


def user_aggregations(events: DataFrame, duration: str = "2 hours", time_col: str = "event_time",
                      user_col: str = "user_id", type_col: str = "action_type", weight_col: str | None = None) -> DataFrame:
    """Totals and per-type counts in one long table, tagged by ``aggregation_type``.

    Batch: per-type counts, and totals summed from them; the events are shuffled once.
    Stream: grouping sets, so there is one stateful operator; ``grouping()`` tells the two
    sets apart.  A NULL action type is never mistaken for the total; its rows are tagged
    ``action:(none)``.  A row stands for ``weight_col`` actions (default: one).
    """
    keyed = events.select(F.col(user_col).alias("user_id"), F.col(type_col).alias("action_type"),
                          tumbling_window(time_col, duration).alias("window"), *([F.col(weight_col).alias("weight")] if weight_col else []))
    if not events.isStreaming:
        agg = totals_and_types(keyed, ["user_id", "window"], "weight" if weight_col else None)
        return agg.select("user_id", *window_bounds("window"), "total_actions", "aggregation_type")
    agg = keyed.groupingSets([["user_id", "window"], ["user_id", "window", "action_type"]],
                             "user_id", "window", "action_type").agg(
        _actions("weight" if weight_col else None),
        F.grouping("action_type").alias("_is_total"),
    )
    tag = F.when(F.col("_is_total") == 1, F.lit(TOTAL_TAG)).otherwise(type_tag())
    return agg.select("user_id", *window_bounds("window"), "total_actions", tag.alias("aggregation_type"))


def totals_and_types(keyed: DataFrame, key: list[str], weight_col: str | None = None) -> DataFrame:
    """``key``, ``total_actions`` and ``aggregation_type`` of rows with ``action_type``.

    Totals are sums of the per-type counts, so the events are shuffled once, already
    counted, and both halves read that one exchange.
    """
    types = keyed.groupBy(*key, "action_type").agg(_actions(weight_col))
    totals = types.groupBy(*key).agg(F.sum("total_actions").alias("total_actions"))
    return totals.select(*key, "total_actions", F.lit(TOTAL_TAG).alias("aggregation_type")).union(
        types.select(*key, "total_actions", type_tag()))
