"""Filters, orders and top-N over the marts, and the numbers shown for the newest run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import two_digits

RISK_LEVELS = ("HIGH", "MEDIUM", "LOW")


def filter_by_values(df: DataFrame, column: str, selected: list[str]) -> DataFrame:
    """Rows whose value, as text, is selected. A column that is not there changes nothing; an empty
    selection leaves no rows."""
    if column not in df.columns:
        return df
    return df.filter(F.col(column).cast("string").isin(*selected)) if selected else df.limit(0)


def risk_rank(level: Column) -> Column:
    rank = F
    for place, name in enumerate(RISK_LEVELS):
        rank = rank.when(level == name, place)
    return rank.otherwise(len(RISK_LEVELS))


def device_order() -> list[Column]:
    return [risk_rank(F.col("risk_level")).asc(), F.desc("attack_rate"), F.desc("total_events"), F.asc("device_id")]


def attack_order() -> list[Column]:
    return [F.desc("total_attack_events"), F.desc("affected_devices"), F.asc("attack_type")]


def protocol_order() -> list[Column]:
    return [F.desc("total_events"), F.desc("attack_events"), F.asc("protocol")]


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The n first rows; the key column at the end of each order makes the cut repeatable."""
    return df.orderBy(*order).limit(n)


def devices_per_risk(risk: DataFrame) -> DataFrame:
    """Device count per level, every level present: three conditional counts in one aggregate."""
    counts = risk.agg(*[F.count_if(F.col("risk_level") == level).alias(level) for level in RISK_LEVELS])
    cells = [F.struct(F.lit(level).alias("risk_level"), F.col(level).alias("device_count")) for level in RISK_LEVELS]
    return counts.select(F.inline(F.array(*cells)))


def options(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values as sorted text (risk levels in their fixed order)."""
    values = df.select(F.col(column).cast("string").alias("option")).dropna().distinct()
    if column == "risk_level":
        return values.filter(F.col("option").isin(*RISK_LEVELS)).orderBy(risk_rank(F.col("option")))
    return values.orderBy("option")


def display(df: DataFrame) -> DataFrame:
    """Every timestamp column as text."""
    return df.select(*[F.col(n).cast("string").alias(n) if t.startswith("timestamp") else F.col(n) for n, t in df.dtypes])


def percent(rate: str) -> Column:
    return F.expr(f"concat({two_digits(f'coalesce(cast({rate} AS double), 0D) * 100')}, '%')")


def overview(quality: DataFrame) -> DataFrame:
    """Headline numbers of the quality mart."""
    return quality.select("processed_records", "invalid_records", "total_records", percent("invalid_rate").alias("invalid_rate"))


def latest_run_numbers(latest: DataFrame) -> DataFrame:
    """Headline numbers of the newest run; missing numbers read as 0."""
    whole = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("processed_records", "invalid_records", "high_risk_devices", "total_alerts")]
    return latest.select("run_id", "status", *whole, percent("invalid_rate").alias("invalid_rate"), "environment")
