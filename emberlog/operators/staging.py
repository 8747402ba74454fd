"""Typed staging frames over the two warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import space_blank_to_null

# Reason patterns in match order. ``_`` inside LIKE matches any one character.
REASON_CATEGORIES = (
    ("invalid json%", "invalid_json"),
    ("%missing required field%", "missing_required_field"),
    ("%invalid timestamp%", "invalid_timestamp"),
    ("%invalid protocol%", "invalid_protocol"),
    ("%packet_size%", "invalid_packet_size"),
    ("%duration_ms%", "invalid_duration"),
    ("%event_type%", "invalid_event_type"),
)
FAILED_STATUSES = ("failed", "error")


def attack_flag(event_type: Column, label: Column) -> Column:
    """Attack event, or any non-blank label (a label on a normal event counts)."""
    return (event_type == "attack") | label.isNotNull()


def failed_flag(status: Column) -> Column:
    return status.isin(*FAILED_STATUSES)


def category(reason: Column) -> Column:
    """First matching pattern wins."""
    lowered = F.lower(reason)
    chain = F
    for pattern, name in REASON_CATEGORIES:
        chain = chain.when(lowered.like(pattern), name)
    return chain.otherwise("other")


def records(rows: DataFrame) -> DataFrame:
    """Text columns of log records in normal form, whatever typed columns stand beside them."""
    folded = {"protocol": F.upper, "event_type": F.lower, "status": F.lower}
    text = {c: F.trim(c) for c in ("device_id", "source_ip", "destination_ip", *folded) if c in rows.columns}
    text |= {c: fold(text[c]) for c, fold in folded.items()}
    return rows.withColumns(text | {"attack_type": F.expr(space_blank_to_null("attack_type"))})


def flagged(normal: DataFrame) -> DataFrame:
    """``is_attack`` and ``is_failed`` beside normal-form columns."""
    return normal.withColumns({
        "is_attack": attack_flag(F.col("event_type"), F.col("attack_type")), "is_failed": failed_flag(F.col("status")),
    })


def stage_processed(rows: DataFrame) -> DataFrame:
    return flagged(records(rows)).select(
        "id", "event_timestamp", F.to_date("event_timestamp").alias("event_date"), F.hour("event_timestamp").alias("event_hour"),
        "device_id", "source_ip", "destination_ip", "protocol", "packet_size", "duration_ms", "event_type", "attack_type", "status",
        "ingestion_timestamp", "processed_at", "inserted_at", "is_attack", "is_failed",
    )


def stage_invalid(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", "raw_payload", "error_reason", "failed_at", "inserted_at",
        category(F.col("error_reason")).alias("error_category"),
    )
