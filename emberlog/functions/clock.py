"""ISO-8601 parsing and the three output spellings (SQL expression text in and out)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from .text import strip

# Calendar date, optional time with optional fraction, optional zone. Compact and week dates are
# not taken (see README, deviations).
ISO_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?)?(Z|[+-][0-9]{2}(:?[0-9]{2}(:?[0-9]{2})?)?)?)?$"
)


def parse_iso(text: str, plain: str | None = None) -> str:
    """UTC timestamp of ISO text, NULL when it is not one. A missing zone means UTC."""
    candidate = strip(text, plain)
    return (
        f"CASE WHEN {candidate} RLIKE '{ISO_PATTERN}' "
        f"THEN try_cast(replace({candidate}, ',', '.') AS timestamp) END"
    )


def iso_seconds(moment: str) -> str:
    return f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def iso_millis(moment: str) -> str:
    return f"date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"


def iso_micros(moment: str) -> str:
    """Seconds, plus six fraction digits only when the fraction is not zero."""
    return (
        f"CASE WHEN unix_micros({moment}) % 1000000 = 0 THEN {iso_seconds(moment)} "
        f"ELSE date_format({moment}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") END"
    )


def moment(value: Column | datetime | str) -> Column:
    """A clock reading given by the caller as a TIMESTAMP column."""
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("timestamp")
