"""Record contracts: the JSON envelope, the metadata payload superset and the
aggregate record."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType,
)

CORRUPT_COL = "_corrupt"

DEVICE_INFO = StructType([
    StructField("device_id", StringType()),
    StructField("device_type", StringType()),
    StructField("os_version", StringType()),
    StructField("app_version", StringType()),
])

# `metadata` stays raw JSON text in the envelope; typed views come from METADATA.
ENVELOPE = StructType([
    StructField("event_id", StringType()),
    StructField("user_id", LongType()),
    StructField("action_type", StringType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("metadata", StringType()),
    StructField("device_info", DEVICE_INFO),
    StructField(CORRUPT_COL, StringType()),
])

# Decoded event as the rest of the package sees it.
EVENT = StructType([
    StructField("event_id", StringType()),
    StructField("user_id", LongType()),
    StructField("action_type", StringType()),
    StructField("event_time", TimestampNTZType()),
    StructField("metadata", StringType()),
    StructField("device_info", DEVICE_INFO),
])

# Payload families of `metadata`, the action types that carry each one,
# and the fields (with types) each family holds.
FAMILIES: dict[str, tuple[list[str], list[tuple[str, object]]]] = {
    "product": (["product_view", "add_to_cart", "remove_from_cart", "product_detail_view"],
                [("product_id", IntegerType()), ("product_name", StringType()),
                 ("category", StringType()), ("price", DoubleType())]),
    "button": (["button_click"],
               [("button_id", StringType()), ("button_text", StringType()), ("screen", StringType())]),
    "search": (["search"], [("query", StringType()), ("results_count", IntegerType())]),
    "checkout": (["checkout_start", "checkout_complete"],
                 [("cart_value", DoubleType()), ("items_count", IntegerType()),
                  ("payment_method", StringType())]),
    "location": (["location_search", "nearby_search"],
                 [("latitude", DoubleType()), ("longitude", DoubleType()), ("radius_km", IntegerType())]),
    "screen": (["screen_view", "screen_exit"],
               [("screen_name", StringType()), ("duration_seconds", IntegerType())]),
}

METADATA = StructType([StructField(name, dtype) for _, fields in FAMILIES.values() for name, dtype in fields])

# Aggregate table record; the key is (user_id, aggregation_type, window_start, window_end).
AGG_KEY = ["user_id", "aggregation_type", "window_start", "window_end"]
AGGREGATE = StructType([
    StructField("user_id", LongType()),
    StructField("window_start", TimestampNTZType()),
    StructField("window_end", TimestampNTZType()),
    StructField("total_actions", LongType()),
    StructField("aggregation_type", StringType()),
    StructField("updated_at", TimestampNTZType()),
    StructField("sequence", LongType()),
    StructField("writer", StringType()),
    StructField("version", LongType()),
])

TOTAL_TAG = "total"
ACTION_TAG_PREFIX = "action:"
#: Stands for the type of records that have none: they count, and every row has a tag.
NO_TYPE = "(none)"
