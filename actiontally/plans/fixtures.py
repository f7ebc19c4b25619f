"""Event inputs derived from the driver's tables.

* ``plain_events``: the ``events`` table as actions (``event_type`` is the action type,
  ``ts`` the event time).
* ``json_envelope``: the same rows published as JSON envelopes, as a topic carries them.
* ``family_envelope``: envelopes whose action types and payloads cover every metadata
  family, with values computed from the row.
* ``open_envelope``: envelopes with payloads of no family.
* ``order_events``: ``orders`` as actions, spread over many months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actiontally.schemas import FAMILIES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def plain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("user_id"),
                    F.col("o_orderpriority").alias("action_type"), F.col("o_orderdate").alias("event_time"))


def iso_time(col: str) -> Column:
    """ISO-8601 without zone; the fraction is left out when it is zero."""
    return F.regexp_replace(F.date_format(F.col(col), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), "[.]000000$", "")


def envelope_fields() -> dict[str, Column]:
    """The record's six fields, from a row of ``events``."""
    uid = F.col("user_id")
    device = F.struct(
        F.concat(F.lit("dev-"), uid).alias("device_id"),
        F.when(uid % 2 == 0, F.lit("ios")).otherwise(F.lit("android")).alias("device_type"),
        F.concat((F.lit(12) + uid % 6).cast("string"), F.lit(".0")).alias("os_version"),
        F.concat((F.lit(1) + uid % 5).cast("string"), F.lit("."), (uid % 10).cast("string"), F.lit(".0"))
        .alias("app_version"),
    )
    return {"event_id": F.concat(F.lit("evt-"), F.col("event_id")), "user_id": uid, "action_type": F.col("event_type"),
            "timestamp": iso_time("ts"), "metadata": F.from_json(F.col("props"), "k int"), "device_info": device}


def json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    env = F.struct(*(c.alias(n) for n, c in envelope_fields().items()))
    return plain_events(spark, sf_dir).select(F.to_json(env).alias("value"))


# Action type cycle of the family fixture and the per-family word lists.
FAMILY_ACTIONS = ["product_view", "add_to_cart", "remove_from_cart", "product_detail_view", "button_click",
                  "search", "checkout_start", "checkout_complete", "location_search", "nearby_search",
                  "screen_view", "screen_exit", "login"]
CATEGORIES = ["Electronics", "Clothing", "Food", "Books", "Toys"]
BUTTON_TEXTS = ["Buy Now", "Add to Cart", "View Details", "Share"]


def _pick(words: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), (idx + 1).cast("int"))


def family_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = plain_events(spark, sf_dir)
    eid, val = F.col("event_id"), F.col("value")
    atype = _pick(FAMILY_ACTIONS, eid % len(FAMILY_ACTIONS))
    pid = (F.lit(1) + eid % 10000).cast("int")
    payloads = {
        "product": F.struct(pid.alias("product_id"), F.concat(F.lit("Product_"), pid).alias("product_name"),
                            _pick(CATEGORIES, eid % 5).alias("category"), val.alias("price")),
        "button": F.struct(F.concat(F.lit("btn_"), F.lit(1) + eid % 100).alias("button_id"),
                           _pick(BUTTON_TEXTS, eid % 4).alias("button_text"), F.lit("home").alias("screen")),
        "search": F.struct(F.lit("book").alias("query"), (eid % 501).cast("int").alias("results_count")),
        "checkout": F.struct(val.alias("cart_value"), (F.lit(1) + eid % 10).cast("int").alias("items_count"),
                             F.lit("paypal").alias("payment_method")),
        "location": F.struct((val - 90.5).alias("latitude"), (val - 180.5).alias("longitude"),
                             (F.lit(1) + eid % 50).cast("int").alias("radius_km")),
        "screen": F.struct(F.lit("cart").alias("screen_name"),
                           (F.lit(1) + eid % 300).cast("int").alias("duration_seconds")),
    }
    meta = F.lit("{}")
    for fam, (actions, _) in reversed(list(FAMILIES.items())):
        meta = F.when(atype.isin(actions), F.to_json(payloads[fam])).otherwise(meta)
    value = F.concat(
        F.lit('{"event_id":"evt-'), eid.cast("string"), F.lit('","user_id":'), F.col("user_id").cast("string"),
        F.lit(',"action_type":"'), atype, F.lit('","timestamp":"'), iso_time("ts"),
        F.lit('","metadata":'), meta,
        F.lit(',"device_info":{"device_id":"dev-'), F.col("user_id").cast("string"),
        F.lit('","device_type":"ios","os_version":"15.0","app_version":"1.0.0"}}'),
    )
    return e.select(value.alias("value"))


def open_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes whose payloads have keys of no family: ``k``; a ``coupon`` in one of three; a ``score``
    that in one of four is a word; a nested ``nav``; a list of ``tags``, empty in one of five."""
    e, eid = plain_events(spark, sf_dir), F.col("event_id")
    meta = F.concat(
        F.lit('{"k":'), F.get_json_object("props", "$.k"), F.when(eid % 3 == 0, F.concat(F.lit(',"coupon":"C'), eid % 50, F.lit('"'))).otherwise(""),
        F.lit(',"score":'), F.when(eid % 4 == 0, F.lit('"n/a"')).otherwise((eid % 100).cast("string")),
        F.lit(',"nav":{"from":"home","depth":'), eid % 7, F.lit('},"tags":'),
        F.when(eid % 5 == 0, F.lit("[]")).otherwise(F.concat(F.lit('["t'), eid % 9, F.lit('","new"]'))), F.lit("}"))
    value = F.concat(F.lit('{"event_id":"evt-'), eid, F.lit('","user_id":'), F.col("user_id"), F.lit(',"action_type":"'), F.col("event_type"),
                     F.lit('","timestamp":"'), iso_time("ts"), F.lit('","metadata":'), meta, F.lit("}"))
    return e.select(value.alias("value"))
