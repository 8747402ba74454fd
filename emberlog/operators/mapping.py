"""Topic messages to warehouse rows; messages that cannot become a row go to quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock, payload
from ..functions.text import blank_to_null
from . import validate

# Field order decides which problem is named first.
TEXT, NUMBER, TIME, OPTIONAL_TEXT, OPTIONAL_TIME = "text", "number", "time", "optional text", "optional time"
PROCESSED_FIELDS = (
    ("event_timestamp", TIME), ("device_id", TEXT), ("source_ip", TEXT), ("destination_ip", TEXT),
    ("protocol", TEXT), ("packet_size", NUMBER), ("duration_ms", NUMBER), ("event_type", TEXT),
    ("attack_type", OPTIONAL_TEXT), ("status", TEXT), ("ingestion_timestamp", OPTIONAL_TIME),
    ("processed_at", TIME),
)
INVALID_FIELDS = (("raw_payload", TEXT), ("error_reason", TEXT), ("failed_at", TIME))
INT_MAX = 2**31 - 1


def _problem(name: str, form: str) -> str:
    """Why this field cannot be stored; NULL when it can. Reads the values under ``row``."""
    gone, blank = payload.is_null(name), payload.is_empty_text(name)
    absent = f"'missing required field: {name}'"
    untimely = (
        f"CASE WHEN {payload.kind(name)} <> 'STRING' THEN '{name} must be a string' "
        f"WHEN {blank} THEN '{name} must not be empty' ELSE 'invalid timestamp for {name}' END"
    )
    if form == TEXT:
        return f"CASE WHEN {gone} OR {blank} THEN {absent} END"
    if form == NUMBER:
        return (
            f"CASE WHEN row.{name} IS NULL THEN '{name} must be an integer' "
            f"WHEN row.{name} NOT BETWEEN {-INT_MAX - 1} AND {INT_MAX} THEN '{name} is out of range for an integer column' END"
        )
    if form == TIME:
        return f"CASE WHEN row.{name} IS NOT NULL THEN NULL WHEN {gone} THEN {absent} ELSE {untimely} END"
    if form == OPTIONAL_TIME:
        return f"CASE WHEN row.{name} IS NULL AND text_{name} IS NOT NULL AND NOT {blank} THEN 'invalid timestamp for {name}' END"
    return "CAST(NULL AS string)"


def _value(name: str, form: str) -> str:
    if form == TEXT:
        return payload.spelled(name)
    if form == OPTIONAL_TEXT:
        return blank_to_null(f"text_{name}", "plain")
    if form == NUMBER:
        return payload.whole_number(name, f"read_{name}")
    if form == OPTIONAL_TIME:
        return clock.parse_iso(f"text_{name}", "plain")
    return f"read_{name}"


def _parsed(shape) -> dict[str, str]:
    times = {f"read_{n}": clock.parse_iso(f"text_{n}", "plain") for n, form in shape if form == TIME}
    return times | {f"read_{n}": payload.integral_text(n) for n, form in shape if form == NUMBER}


def _doubts(shape) -> str:
    """When a message needs the second look: a required field without text, a value that does not parse, a boolean."""
    required = [f"text_{name} IS NULL" for name, form in shape if form in (TEXT, NUMBER, TIME)]
    texts = [name for name, form in shape if form == TEXT]
    return " OR ".join([*required, *[f"{n} IS NULL" for n in _parsed(shape)], payload.reads_boolean(*texts)])


def _first_problem(shape) -> str:
    return (
        "CASE payload_kind WHEN 'bad_json' THEN 'invalid JSON: malformed document' "
        f"WHEN 'other' THEN 'payload must be a JSON object' ELSE coalesce({', '.join(_problem(name, form) for name, form in shape)}) END"
    )


def _mapped(df: DataFrame, value: str, *choices: tuple[str, tuple]) -> DataFrame:
    """Read each message once and give it ``problem`` and ``row``: by the fields of the first (condition, fields) whose
    condition holds; where none does, ``problem`` is left to the caller (NULL, and an empty row)."""
    keys = [c for c in df.columns if c != value]
    fields = [field for _, shape in choices for field in shape]
    parsed = {name: sql for _, shape in choices for name, sql in _parsed(shape).items()}
    doubts = " ".join(f"WHEN {test} THEN {_doubts(shape)}" for test, shape in choices)
    ready = payload.read(df, value, (), parsed, f"(CASE {doubts} ELSE false END)", [name for name, _ in fields])
    row = ", ".join(f"{_value(name, form)} AS {name}" for name, form in fields)
    problem = " ".join(f"WHEN {test} THEN {_first_problem(shape)}" for test, shape in choices)
    shaped = ready.selectExpr("*", f"struct({row}) AS row")
    return payload.once(shaped, f"CASE {problem} END AS problem", "row AS mapped").select(
        *keys, "raw_text", "problem", F.col("mapped").alias("row")
    )


def map_processed(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``problem`` and the warehouse columns under ``row`` for processed-topic messages."""
    return _mapped(df, value, ("true", PROCESSED_FIELDS))


def map_invalid(df: DataFrame, value: str = "value") -> DataFrame:
    return _mapped(df, value, ("true", INVALID_FIELDS))


def _id(position: Column) -> Column:
    return position.cast("bigint").alias("id")


def processed_rows(mapped: DataFrame, position: Column, inserted_at: Column | str) -> DataFrame:
    """Rows of the processed table. ``position`` is the unique source position of the message."""
    casts = {"packet_size": "int", "duration_ms": "int"}
    columns = [F.col(f"row.{n}").cast(casts[n]).alias(n) if n in casts else F.col(f"row.{n}") for n, _ in PROCESSED_FIELDS]
    return mapped.filter("problem IS NULL").select(
        _id(position), *columns, F.col("raw_text").alias("raw_payload"), clock.moment(inserted_at).alias("inserted_at")
    )


def invalid_rows(mapped: DataFrame, position: Column, inserted_at: Column | str) -> DataFrame:
    return mapped.filter("problem IS NULL").select(
        _id(position), "row.*", clock.moment(inserted_at).alias("inserted_at")
    )


def quarantine_rows(mapped: DataFrame, position: Column, inserted_at: Column | str) -> DataFrame:
    """Messages the loader could not map, kept with the reason instead of dropped."""
    return mapped.filter("problem IS NOT NULL").select(
        _id(position), "raw_text", F.col("problem").alias("reason"), clock.moment(inserted_at).alias("inserted_at")
    )


def loaded_rows(messages: DataFrame, inserted_at: Column | str) -> DataFrame:
    """Messages (id, value, topic) of both topics as rows of the three loaded tables, in one pass.

    Columns of LOADED and ``target``, the table of the row. Messages that fit no table, and those of a topic
    nobody asked for, are quarantined with the reason.
    """
    topics = {validate.PROCESSED_TOPIC: PROCESSED_FIELDS, validate.INVALID_TOPIC: INVALID_FIELDS}
    mapped = _mapped(messages.select("id", "value", "topic"), "value", *[(f"topic = '{t}'", fields) for t, fields in topics.items()])
    known = F.coalesce(F.col("topic").isin(*topics), F.lit(False))
    stray = F.concat(F.lit("received message from unexpected topic "), F.coalesce("topic", F.lit("null")))
    reasoned = mapped.withColumn("reason", F.when(known, F.col("problem")).otherwise(stray))
    good = F.col("reason").isNull()
    processed = good & (F.col("topic") == validate.PROCESSED_TOPIC)
    casts = {"packet_size": "int", "duration_ms": "int"}
    names = [n for n, _ in (*PROCESSED_FIELDS, *INVALID_FIELDS) if n != "raw_payload"]
    return reasoned.select(
        "id", *[F.when(good, F.col(f"row.{n}")).cast(casts[n]).alias(n) if n in casts else F.when(good, F.col(f"row.{n}")).alias(n) for n in names],
        F.when(processed, F.col("raw_text")).when(good, F.col("row.raw_payload")).alias("raw_payload"),
        F.when(~good, F.col("raw_text")).alias("raw_text"), "reason", clock.moment(inserted_at).alias("inserted_at"),
        F.when(~good, "load_quarantine").when(processed, "processed_iot_logs").otherwise("invalid_iot_logs").alias("target"),
    )


def rows_from_valid(valid: DataFrame, position: Column, inserted_at: Column | str) -> DataFrame:
    """Processed-table rows straight from validated records, skipping the JSON round trip.

    Same rows as publishing and mapping them, except that ``raw_payload`` is the incoming text.
    """
    return valid.filter("storable").select(
        _id(position),
        "event_timestamp", "device_id", "source_ip", "destination_ip", "protocol",
        F.expr("cast(packet_size AS int) AS packet_size"),
        F.expr("cast(duration_ms AS int) AS duration_ms"),
        "event_type",
        F.expr(f"{blank_to_null('attack_type')} AS attack_type"),
        "status",
        F.expr(f"{clock.parse_iso('ingestion_timestamp')} AS ingestion_timestamp"),
        "processed_at",
        F.col("raw_text").alias("raw_payload"),
        clock.moment(inserted_at).alias("inserted_at"),
    )
