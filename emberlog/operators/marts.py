"""The four marts. Each is one aggregation over staged rows with map-side partial aggregates, so a
device, label or protocol that holds a large share of all rows sends one partial row per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import rate, rounded_mean, tally

HIGH_RATE, MEDIUM_RATE = 0.50, 0.20
UNKNOWN_LABEL = "unknown"


def _events() -> Column:
    return F.count(F.lit(1))


def _share(flag: str) -> Column:
    return F.coalesce(rate(tally(F.col(flag)), _events()), F.lit(0.0))


def seen(name: str = "seen") -> list[Column]:
    return [F.min("event_timestamp").alias(f"first_{name}"), F.max("event_timestamp").alias(f"last_{name}")]


def _means() -> list[Column]:
    return [rounded_mean(F.col(c)).alias(f"avg_{c}") for c in ("packet_size", "duration_ms")]


def flag_measures(flags: dict[str, str]) -> list[Column]:
    """Number and share of rows for every flag: ``<name>_events`` and ``<name>_event_ratio``."""
    return [m for name, flag in flags.items() for m in (tally(F.col(flag)).alias(f"{name}_events"), _share(flag).alias(f"{name}_event_ratio"))]


def risk_band(attack_rate: Column, failure_rate: Column) -> Column:
    """Bands on the already rounded rates."""
    worst = F.greatest(attack_rate, failure_rate)
    return F.when(worst >= HIGH_RATE, "HIGH").when(worst >= MEDIUM_RATE, "MEDIUM").otherwise("LOW")


def device_risk(staged: DataFrame) -> DataFrame:
    kinds = [tally(F.col("event_type") == k).alias(f"{k}_events") for k in ("normal", "warning", "error")]
    per_device = staged.groupBy("device_id").agg(
        _events().alias("total_events"),
        tally(F.col("is_attack")).alias("attack_events"),
        tally(F.col("is_failed")).alias("failed_events"),
        *kinds,
        _share("is_attack").alias("attack_rate"),
        _share("is_failed").alias("failure_rate"),
        *_means(),
        *seen(),
    )
    return per_device.withColumn("risk_level", risk_band(F.col("attack_rate"), F.col("failure_rate")))


def attack_summary(staged: DataFrame) -> DataFrame:
    label = F.coalesce(F.nullif(F.trim("attack_type"), F.lit("")), F.lit(UNKNOWN_LABEL))
    return (
        staged.filter("is_attack")
        .groupBy(label.alias("attack_type"))
        .agg(
            _events().alias("total_attack_events"),
            F.count_distinct("device_id").alias("affected_devices"),
            *_means(),
            *seen(),
        )
    )


def protocol_metrics(staged: DataFrame) -> DataFrame:
    return staged.groupBy("protocol").agg(
        _events().alias("total_events"),
        tally(F.col("is_attack")).alias("attack_events"),
        tally(F.col("is_failed")).alias("failed_events"),
        _share("is_attack").alias("attack_rate"),
        *_means(),
        *seen(),
    )


def outcome_totals(outcomes: DataFrame) -> DataFrame:
    """One row from (outcome, at): how many messages were processed and rejected, and when last."""
    of = {"processed": F.col("outcome") == "processed", "invalid": F.col("outcome") == "invalid"}
    return outcomes.agg(
        *[F.count_if(test).alias(f"{name}_records") for name, test in of.items()], *[F.max(F.when(test, F.col("at"))).alias(f"last_{name}_at") for name, test in of.items()]
    )


def quality_of(totals: DataFrame) -> DataFrame:
    """The quality mart from one row of ``outcome_totals``."""
    total = F.col("processed_records") + F.col("invalid_records")
    return totals.select(
        "processed_records", "invalid_records", total.alias("total_records"),
        F.coalesce(rate(F.col("invalid_records"), total), F.lit(0.0)).alias("invalid_rate"), "last_processed_at", "last_invalid_at",
    )


def quality_summary(staged: DataFrame, staged_invalid: DataFrame) -> DataFrame:
    """One row over both staged tables. Where one pass over checked messages gives both outcomes, use ``quality_of``."""
    good = staged.select(F.lit("processed").alias("outcome"), F.col("processed_at").alias("at"))
    bad = staged_invalid.select(F.lit("invalid").alias("outcome"), F.col("failed_at").alias("at"))
    return quality_of(outcome_totals(good.unionByName(bad)))
