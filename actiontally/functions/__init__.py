"""Column-level building blocks (all built-in Spark expressions)."""

from actiontally.functions.decode import (
    decode_events, device_info_flat, encode_json, family_payload, metadata_struct, open_payload, payload_keys,
    split_corrupt,
)
from actiontally.functions.layout import (
    event_date, event_hour, user_bucket, with_partition_columns, yyyymm,
)
from actiontally.functions.windows import tumbling_window, window_bounds

__all__ = [
    "decode_events", "device_info_flat", "encode_json", "family_payload", "metadata_struct",
    "open_payload", "payload_keys", "split_corrupt", "event_date", "event_hour", "user_bucket", "with_partition_columns", "yyyymm",
    "tumbling_window", "window_bounds",
]
