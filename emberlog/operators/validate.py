"""Field rules on raw messages: split into normalized records and rejected messages with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock, payload
from ..functions.text import quote_list, strip

# Required keys in report order, the closed domains and the topic names.
REQUIRED_FIELDS = (
    "event_timestamp", "device_id", "source_ip", "destination_ip", "protocol",
    "packet_size", "duration_ms", "event_type", "status",
)
PROTOCOLS = ("TCP", "UDP", "ICMP")
EVENT_TYPES = ("normal", "warning", "error", "attack")
PROCESSED_TOPIC = "iot_processed_logs"
INVALID_TOPIC = "iot_invalid_logs"

BAD_JSON = "invalid JSON: malformed document"
NOT_OBJECT = "payload must be a JSON object"

OPTIONAL_FIELDS = ("attack_type", "ingestion_timestamp")
SPELLED = ("device_id", "source_ip", "destination_ip", "status")

# first reading of the fields that must parse, and when the message deserves a second look
PARSED = {
    "moment": clock.parse_iso("text_event_timestamp", "plain"),
    "size_read": payload.integral_text("packet_size"),
    "span_read": payload.integral_text("duration_ms"),
}
DOUBTS = f"moment IS NULL OR size_read IS NULL OR span_read IS NULL OR {payload.reads_boolean(*SPELLED)}"

# normalized value of every field, over a frame prepared by payload.read
NORMALIZED = {
    "event_timestamp": "moment",
    "device_id": payload.spelled("device_id"),
    "source_ip": payload.spelled("source_ip"),
    "destination_ip": payload.spelled("destination_ip"),
    "protocol": f"upper({strip('text_protocol', 'plain')})",
    "packet_size": payload.whole_number("packet_size", "size_read"),
    "duration_ms": payload.whole_number("duration_ms", "span_read"),
    "event_type": f"lower({strip('text_event_type', 'plain')})",
    "status": f"lower({payload.spelled('status')})",
}

# type problems in report order, over the normalized columns; only text can match the ISO pattern,
# so the type of the timestamp matters on failure alone
TYPE_PROBLEMS = (
    f"CASE WHEN event_timestamp IS NULL THEN CASE WHEN {payload.kind('event_timestamp')} = 'STRING' "
    "THEN 'invalid timestamp' ELSE 'event_timestamp must be a string' END END",
    f"CASE WHEN protocol IN ({quote_list(PROTOCOLS)}) THEN NULL ELSE 'invalid protocol' END",
    "CASE WHEN packet_size >= 0 THEN NULL ELSE 'packet_size must be a non-negative integer' END",
    "CASE WHEN duration_ms >= 0 THEN NULL ELSE 'duration_ms must be a non-negative integer' END",
    f"CASE WHEN event_type IN ({quote_list(EVENT_TYPES)}) THEN NULL ELSE 'invalid event_type' END",
)


# holds for every message without a fault, so the texts of the reasons are built for faulty ones only
FAULTLESS = (
    f"checked_json IS NULL AND protocol IN ({quote_list(PROTOCOLS)}) AND event_type IN ({quote_list(EVENT_TYPES)}) "
    "AND packet_size >= 0 AND duration_ms >= 0 "
    "AND device_id <> '' AND source_ip <> '' AND destination_ip <> '' AND status <> ''"
)


# counts that fit the INT columns of the warehouse table
STORABLE = f"packet_size <= {2**31 - 1} AND duration_ms <= {2**31 - 1}"


# a message without escapes that has the required fields, optional ones as texts, and nothing else: as many names as fields
_OPTIONAL_TEXTS = " AND ".join(f"(text_{n} IS NULL AND NOT contains(raw_text, '\"{n}\"') OR contains(raw_text, concat('\"{n}\":\"', text_{n}, '\"')))" for n in OPTIONAL_FIELDS)
_NAMES = f"{len(REQUIRED_FIELDS)} + " + " + ".join(f"cast(text_{n} IS NOT NULL AS int)" for n in OPTIONAL_FIELDS)
BARE = (
    f"coalesce(plain AND checked_json IS NULL AND octet_length(raw_text) - octet_length(replace(raw_text, '\":', '')) = 2 * ({_NAMES}) AND {_OPTIONAL_TEXTS}, false)"
)


def check(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``raw_text``, the normalized columns, the texts of the optional fields, ``error_reason``
    (NULL for a valid message) and ``storable``.

    Missing fields are all reported, in declared order, and stop the type checks; type checks
    report every failing field.
    """
    keep = [*df.columns, "raw_text"]
    ready = payload.read(df, value, REQUIRED_FIELDS, PARSED, DOUBTS, OPTIONAL_FIELDS)
    shaped = ready.selectExpr("*", *[f"{sql} AS {name}" for name, sql in NORMALIZED.items()])
    missing = ", ".join(
        f"CASE WHEN {payload.is_absent(n)} OR {payload.is_empty_text(n)} THEN 'missing required field: {n}' END"
        for n in REQUIRED_FIELDS
    )
    reason = (
        f"CASE WHEN {FAULTLESS} THEN NULL "
        f"WHEN payload_kind = 'bad_json' THEN '{BAD_JSON}' WHEN payload_kind = 'other' THEN '{NOT_OBJECT}' "
        f"ELSE coalesce(nullif(concat_ws('; ', {missing}), ''), nullif(concat_ws('; ', {', '.join(TYPE_PROBLEMS)}), '')) END"
    )
    # every result leaves through the generator: a later filter on any of them stays above it
    results = [*NORMALIZED, *[f"text_{n} AS {n}" for n in OPTIONAL_FIELDS], f"{reason} AS _reason", f"{STORABLE} AS _storable", f"{BARE} AS _bare"]
    ready = shaped.selectExpr(*keep, *results)
    passed = [*OPTIONAL_FIELDS, *NORMALIZED, "_reason AS error_reason", "_storable AS storable", "_bare AS bare"]
    return ready.selectExpr(*keep, f"inline(array(struct({', '.join(passed)})))").select(*keep, *OPTIONAL_FIELDS, *NORMALIZED, "error_reason", "storable", "bare")


def _positions(df: DataFrame, *dropped: str) -> list[str]:
    """Columns of the incoming frame that travel with a message (row id, offset, day)."""
    own = {"raw_text", "error_reason", "storable", "bare", "value", "key", "topic", *OPTIONAL_FIELDS, *NORMALIZED, *dropped}
    return [c for c in df.columns if c not in own]


def normalized(checked: DataFrame, processed_at: Column | str) -> DataFrame:
    """Valid messages only: typed normalized columns, ``attack_type`` untouched, ``processed_at``."""
    return checked.filter("error_reason IS NULL").select(
        *_positions(checked), "raw_text", *NORMALIZED, *OPTIONAL_FIELDS, "storable", "bare",
        clock.moment(processed_at).alias("processed_at"),
    )


def outcomes(checked: DataFrame, at: Column | str) -> DataFrame:
    """What becomes of each message, from one pass: ``processed``, ``invalid``, or null where a valid one does not fit the table."""
    outcome = F.when(F.col("error_reason").isNotNull(), "invalid").when(F.col("storable"), "processed")
    return checked.select(outcome.alias("outcome"), clock.moment(at).alias("at"))


def processed_value() -> Column:
    """JSON of a valid record: every incoming field kept, normalized ones replaced.

    A message with declared fields only (``bare``) is written from its columns; any other is read again for the fields
    to keep.
    """
    written = {name: name for name in NORMALIZED}
    written["event_timestamp"] = clock.iso_micros("event_timestamp")
    written["processed_at"] = clock.iso_micros("processed_at")
    entries = ", ".join(f"'{name}', cast({sql} AS variant)" for name, sql in written.items())
    others = f"map_filter(cast(parse_json(raw_text) AS map<string,variant>), (k, v) -> k NOT IN ({quote_list(written)}))"
    flat = ", ".join([*sorted(OPTIONAL_FIELDS), *[f"{sql} AS {name}" for name, sql in written.items()]])
    return F.expr(f"CASE WHEN bare THEN to_json(struct({flat})) ELSE to_json(map_concat({others}, map({entries}))) END")


def processed_messages(valid: DataFrame) -> DataFrame:
    """Outgoing messages of valid records, keyed by device."""
    keys = _positions(valid, "processed_at")
    return valid.select(*keys, F.col("device_id").alias("key"), processed_value().alias("value"))


def rejected(checked: DataFrame, failed_at: Column | str) -> DataFrame:
    """Dead-letter columns of messages that broke a rule."""
    return checked.filter("error_reason IS NOT NULL").select(
        *_positions(checked), F.col("raw_text").alias("raw_payload"), "error_reason",
        clock.moment(failed_at).alias("failed_at"),
    )


def rejected_value() -> Column:
    return F.expr(f"to_json(struct(raw_payload, error_reason, {clock.iso_micros('failed_at')} AS failed_at))")


def rejected_messages(invalid: DataFrame) -> DataFrame:
    """Outgoing dead-letter messages, without a key."""
    keys = _positions(invalid, "raw_payload", "failed_at")
    return invalid.select(*keys, F.lit(None).cast("string").alias("key"), rejected_value().alias("value"))


def routed(df: DataFrame, now: Column | str, value: str = "value") -> DataFrame:
    """Both outgoing topics from one pass over the messages: ``topic``, ``key``, ``value`` plus the
    incoming position columns. One checked frame feeds one projection, so a writer partitioned by
    ``topic`` needs a single job and no cache."""
    checked = check(df, value)
    keys = _positions(df)
    flat = checked.select(
        *keys, "raw_text", "error_reason", *NORMALIZED, *OPTIONAL_FIELDS, "bare", F.col("raw_text").alias("raw_payload"),
        clock.moment(now).alias("processed_at"), clock.moment(now).alias("failed_at"),
    )
    good = F.col("error_reason").isNull()
    return flat.select(
        *keys,
        F.when(good, PROCESSED_TOPIC).otherwise(INVALID_TOPIC).alias("topic"),
        F.when(good, F.col("device_id")).alias("key"),
        F.when(good, processed_value()).otherwise(rejected_value()).alias("value"),
    )
