"""JSON envelope decode/encode and the typed payload projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actiontally.schemas import CORRUPT_COL, ENVELOPE, FAMILIES, METADATA

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}


def decode_events(raw: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Parse the JSON envelope into typed columns.

    ``timestamp`` is read as TIMESTAMP_NTZ, which accepts the zone-less ISO form with or
    without a fraction.  Records that fail to parse, wholly or in one field, keep their
    text in ``_corrupt``; bad fields become NULL.  ``metadata`` stays raw JSON.

    The parsed struct is expanded with ``inline``: a generator's output is opaque to
    predicate push-down, so later filters (``split_corrupt``, the watermark) read the
    parsed columns instead of having the optimizer copy the parse into each predicate.
    """
    cols = [F.col(c) for c in (keep or [])]
    env = F.from_json(F.col(value_col).cast("string"), ENVELOPE, _PERMISSIVE)
    parsed = raw.select(*cols, F.inline(F.array(env)))
    return parsed.select(*cols, "event_id", "user_id", "action_type", F.col("timestamp").alias("event_time"),
                         "metadata", "device_info", CORRUPT_COL)


def countable(time_col: str = "event_time", user_col: str = "user_id") -> Column:
    """Whether a decoded record parsed cleanly and has the two fields every aggregate keys on."""
    return F.col(CORRUPT_COL).isNull() & F.col(user_col).isNotNull() & F.col(time_col).isNotNull()


def split_corrupt(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(countable events, rejected records).  Each output re-runs the decode; a batch job
    that writes both should persist ``decoded`` first, a stream land both in one query."""
    ok = countable()
    return decoded.filter(ok).drop(CORRUPT_COL), decoded.filter(~ok)


def metadata_struct(col: str | Column = "metadata") -> Column:
    """Typed view of the payload: the superset of all family fields, absent ones NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, METADATA)


def family_payload(decoded: DataFrame, family: str, keep: tuple[str, ...] = ("event_id", "user_id", "action_type")
                   ) -> DataFrame:
    """Rows of one payload family with that family's typed fields."""
    actions, fields = FAMILIES[family]
    return (decoded.filter(F.col("action_type").isin(actions))
            .select(*keep, metadata_struct().alias("m"))
            .select(*keep, *[F.col(f"m.{name}").alias(name) for name, _ in fields]))


def open_payload(decoded: DataFrame, fields: dict[str, tuple[str, str]], keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Typed fields of payloads outside the six families: ``fields`` maps a column's name to a
    path (``$.nav.depth``, ``$.tags[0]``) and a type.  The payload is parsed once per record, into a
    variant.  An absent key, a value that does not convert and a payload that is no JSON give NULL."""
    parsed = decoded.select(*keep, F.try_parse_json("metadata").alias("_payload"))
    return parsed.select(*keep, *[F.try_variant_get("_payload", path, kind).alias(name) for name, (path, kind) in fields.items()])


def payload_keys(decoded: DataFrame, by: tuple[str, ...] = ("action_type",)) -> DataFrame:
    """Which top-level keys payloads carry, and as what: ``by, key, kind, n_events``.  ``kind`` is the
    value's outermost type, so a key that is sometimes mistyped has several rows.  Payloads that
    are no JSON objects have no keys.  One shuffle of counted rows."""
    parsed = decoded.select(*by, F.try_parse_json("metadata").alias("_payload")).filter("_payload is not null")
    pairs = parsed.lateralJoin(decoded.sparkSession.tvf.variant_explode(F.col("_payload").outer())).filter("key is not null")
    kind = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    return pairs.groupBy(*by, "key", kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_events"))


def device_info_flat(decoded: DataFrame, keep: tuple[str, ...] = ("event_id",)) -> DataFrame:
    return decoded.select(*keep, "device_info.*")


def encode_json(df: DataFrame, fields: dict[str, str | Column], key: str | None = None) -> DataFrame:
    """One JSON text per row (``value``), as a topic producer would publish it."""
    parts = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]
    out = [F.to_json(F.struct(*parts)).alias("value")]
    return df.select(*([F.col(key)] if key else []), *out)
