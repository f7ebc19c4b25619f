"""DuckDB statements computing what each registered query must return, from the same
Parquet tables (views ``events``, ``orders``, ...)."""

from __future__ import annotations

from actiontally.plans.fixtures import BUTTON_TEXTS, CATEGORIES, FAMILY_ACTIONS


def _bucket(interval: str, ts: str = "ts") -> str:
    return f"time_bucket(interval '{interval}', {ts}, timestamp '1970-01-01')"


B2, B5 = _bucket("2 hours"), _bucket("5 minutes")

COUNTS_2H = f"""select user_id, {B2} window_start, {B2} + interval '2 hours' window_end,
       count(*) total_actions from events group by all"""

TYPES_2H = f"""select user_id, event_type action_type, {B2} window_start,
       {B2} + interval '2 hours' window_end, count(*) total_actions from events group by all"""

COUNTS_5M = f"""select user_id, {B5} window_start, {B5} + interval '5 minutes' window_end,
       count(*) total_actions from events group by all"""


def _u1(src: str = "events", user: str = "user_id", ts: str = "ts", atype: str = "event_type") -> str:
    b = _bucket("2 hours", ts)
    return f"""select user_id, window_start, window_start + interval '2 hours' window_end, total_actions,
       aggregation_type
from (select {user} user_id, {b} window_start, count(*) total_actions, 'total' aggregation_type
      from {src} group by all
      union all
      select {user} user_id, {b} window_start, count(*) total_actions, 'action:' || {atype} aggregation_type
      from {src} group by {user}, {b}, {atype})"""


U1 = _u1()

DECODE = """select 'evt-' || event_id event_id, user_id, event_type action_type, ts event_time,
       cast(json_extract_string(props, '$.k') as int) k,
       case when user_id % 2 = 0 then 'ios' else 'android' end device_type,
       (12 + user_id % 6) || '.0' os_version,
       (1 + user_id % 5) || '.' || (user_id % 10) || '.0' app_version
from events"""

DEVICE = """select 'evt-' || event_id event_id, 'dev-' || user_id device_id,
       case when user_id % 2 = 0 then 'ios' else 'android' end device_type,
       (12 + user_id % 6) || '.0' os_version,
       (1 + user_id % 5) || '.' || (user_id % 10) || '.0' app_version
from events"""

_ACTION = f"list_extract({FAMILY_ACTIONS!r}, cast(event_id % 13 + 1 as int))"


def _family(idx: str, fields: str) -> str:
    return f"""select 'evt-' || event_id event_id, user_id, {_ACTION} action_type,
       {fields}
from events where event_id % 13 in ({idx})"""


FAMILY = {
    "product": _family("0, 1, 2, 3", f"""cast(1 + event_id % 10000 as int) product_id,
       'Product_' || (1 + event_id % 10000) product_name,
       list_extract({CATEGORIES!r}, cast(event_id % 5 + 1 as int)) category,
       value price"""),
    "button": _family("4", f"""'btn_' || (1 + event_id % 100) button_id,
       list_extract({BUTTON_TEXTS!r}, cast(event_id % 4 + 1 as int)) button_text,
       'home' screen"""),
    "search": _family("5", """'book' "query", cast(event_id % 501 as int) results_count"""),
    "checkout": _family("6, 7", """value cart_value, cast(1 + event_id % 10 as int) items_count,
       'paypal' payment_method"""),
    "location": _family("8, 9", """value - 90.5 latitude, value - 180.5 longitude,
       cast(1 + event_id % 50 as int) radius_km"""),
    "screen": _family("10, 11", """'cart' screen_name, cast(1 + event_id % 300 as int) duration_seconds"""),
}

OPEN = """select 'evt-' || event_id event_id, cast(json_extract_string(props, '$.k') as int) k,
       case when event_id % 3 = 0 then 'C' || (event_id % 50) end coupon,
       case when event_id % 4 <> 0 then cast(event_id % 100 as int) end score, cast(event_id % 7 as int) depth,
       case when event_id % 5 <> 0 then 't' || (event_id % 9) end tag from events"""

KEYS = """select event_type action_type, key, kind, count(*) n_events from (
  select event_type, unnest([{'key': 'k', 'kind': 'BIGINT'}, {'key': case when event_id % 3 = 0 then 'coupon' end, 'kind': 'STRING'},
    {'key': 'score', 'kind': case when event_id % 4 = 0 then 'STRING' else 'BIGINT' end},
    {'key': 'nav', 'kind': 'OBJECT'}, {'key': 'tags', 'kind': 'ARRAY'}], recursive := true) from events)
where key is not null group by all"""

ENCODE = DECODE.replace("event_type action_type, ts event_time,", "event_type action_type, ts event_time, 'dev-' || user_id device_id,")

PARTS = """select event_id, cast(ts as date) event_date,
       cast((extract(hour from ts) // 2) * 2 as int) event_hour, cast(user_id % 128 as int) bucket from events"""

LAKE_ROUNDTRIP = """select event_id, ts, user_id, event_type, value, props, cast(ts as date) event_date,
       cast((extract(hour from ts) // 2) * 2 as int) event_hour, cast(user_id % 128 as int) bucket from events"""

LAKE_LAYOUT = """select cast(ts as date) event_date, cast((extract(hour from ts) // 2) * 2 as int) event_hour,
       cast(user_id % 128 as int) bucket, count(*) n_events from events group by all"""

LAKE_PACKED = """select cast(ts as date) event_date, cast((extract(hour from ts) // 2) * 2 as int) event_hour,
       count(*) n_events, cast(sum(event_id) as bigint) id_sum, true bounded from events group by all"""

LAKE_LOOKUP = """select event_id, ts, event_type from events where user_id = 8
  and ts >= timestamp '2024-01-05 03:00:00' and ts < timestamp '2024-01-09 05:00:00'"""

EVENT_LOOKUP = """select event_id, ts, user_id, event_type from events where event_id = 77"""

BUCKET_LAYOUT = """select 'event_date=' || cast(ts as date) || '/event_hour=' || cast((extract(hour from ts) // 2) * 2 as int)
       || '/bucket=' || (user_id % 128) leaf, count(*) n_events from events
where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-12' group by all"""


def _changes() -> str:
    parts = []
    for v, cutoff in enumerate(["where ts < timestamp '2024-01-10'", "where ts < timestamp '2024-01-20'", ""]):
        parts.append(f"""select user_id, {B2} window_start, {B2} + interval '2 hours' window_end,
       count(*) total_actions, cast({v} as bigint) version
from events {cutoff} group by all""")
    return "\nunion all\n".join(parts)


LATEST = f"""with changes as ({_changes()})
select user_id, window_start, window_end, total_actions, version from changes
qualify row_number() over (partition by user_id, window_start, window_end order by version desc) = 1"""

KEY_LOOKUP = f"""select user_id, window_start, total_actions from ({U1})
where user_id = 8 and aggregation_type = 'total'
  and window_start >= timestamp '2024-01-05' and window_start < timestamp '2024-01-06'"""

CURRENT_LOOKUP = f"""select user_id, window_start, total_actions from ({U1})
where user_id = 8 and aggregation_type = 'total' and window_start >= timestamp '2024-01-05'"""

BACKFILL_THEN_STREAM = f"""select * replace (case when window_start >= timestamp '2024-01-10' and window_start < timestamp '2024-01-12'
       then 2 * total_actions else total_actions end as total_actions) from ({U1})"""

TYPELESS = _u1("(select *, case when event_id % 50 <> 0 then event_type else '(none)' end t from events)", atype="t")

CHAINED = f"""with w as (select * from ({COUNTS_2H}) where window_end <= (select max(ts) from events) - interval 10 minute)
select '2 hours' size, * from w
union all select '5 minutes', * from ({COUNTS_5M}) where window_start < (select max(window_end) from w)"""

STATE_AUDIT = f"""select user_id, window_start, window_end, aggregation_type, total_actions in_state, total_actions in_table
from ({U1}) where window_end > (select max(ts) from events) - interval 10 minute"""

FAN_OUT = f"""select 'lake' sink, null::bigint user_id, {B2} window_start, null::varchar aggregation_type, count(*) total_actions
from events group by all
union all select 'rejects', null, null, null, count(*) from events where event_id % 100 = 0
union all select 'user_aggregations', user_id, window_start, aggregation_type, total_actions from ({TYPELESS})
union all select 'user_aggregations_realtime', user_id, window_start, 'total', total_actions from ({COUNTS_5M})"""

ORDERS_U1 = _u1("(select o_custkey, o_orderdate, o_orderpriority from orders)", "o_custkey", "o_orderdate",
                "o_orderpriority")

MONTHS = f"""select cast(strftime(window_start, '%Y%m') as int) yyyymm, count(*) n_rows,
       cast(sum(total_actions) as bigint) actions from ({ORDERS_U1}) group by all"""

TTL = f"""select * from ({COUNTS_5M}) where window_start + interval 7 day > timestamp '2024-01-31'"""

CLOSED = f"""select * from ({COUNTS_2H})
where window_end <= (select max(ts) from events) - interval 10 minute"""

ORACLE_SQL: dict[str, str] = {
    "user_actions_2h": COUNTS_2H,
    "user_action_types_2h": TYPES_2H,
    "user_actions_5m": COUNTS_5M,
    "user_aggregations_2h": U1,
    "decode_events": DECODE,
    "device_info_flatten": DEVICE,
    **{f"metadata_{k}": v for k, v in FAMILY.items()},
    "metadata_variant": OPEN,
    "metadata_keys": KEYS,
    "encode_events": ENCODE,
    "partition_columns": PARTS,
    "lake_roundtrip": LAKE_ROUNDTRIP,
    "lake_layout": LAKE_LAYOUT,
    "lake_packed": LAKE_PACKED,
    "lake_point_lookup": LAKE_LOOKUP,
    "lake_event_lookup": EVENT_LOOKUP,
    "lake_bucket_layout": BUCKET_LAYOUT,
    "lake_backfill_2h": U1,
    "agg_latest_wins": LATEST,
    "agg_compacted": U1,
    "agg_key_lookup": KEY_LOOKUP,
    "agg_current_lookup": CURRENT_LOOKUP,
    "agg_backfill_then_stream": BACKFILL_THEN_STREAM,
    "agg_replay_after_backfill": BACKFILL_THEN_STREAM,
    "late_slot_repair": U1,
    "agg_month_partitions": MONTHS,
    "realtime_ttl_7d": TTL,
    "stream_user_aggregations_2h": U1,
    "stream_user_actions_5m": COUNTS_5M,
    "stream_append_closed_windows": CLOSED,
    "stream_late_data": CLOSED,
    "stream_seeded_restart": U1,
    "stream_chained_windows": CHAINED,
    "stream_state_audit": STATE_AUDIT,
    "stream_fan_out": FAN_OUT,
    "stream_fan_out_once": FAN_OUT,
}
