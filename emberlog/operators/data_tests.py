"""Declared data tests: not_null, unique and accepted_values per model."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class ModelTests:
    not_null: tuple[str, ...]
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def count(self) -> int:
        return len(self.not_null) + len(self.unique) + len(self.accepted)


# The declared tests of every model.
STAGED_PROCESSED = ModelTests(
    not_null=(
        "id", "event_timestamp", "event_date", "event_hour", "device_id", "source_ip", "destination_ip",
        "protocol", "packet_size", "duration_ms", "event_type", "status", "processed_at", "inserted_at",
        "is_attack", "is_failed",
    ),
    unique=("id",),
    accepted={
        "protocol": ("TCP", "UDP", "ICMP"),
        "event_type": ("normal", "warning", "error", "attack"),
        "status": ("success", "failed", "blocked"),
    },
)
STAGED_INVALID = ModelTests(
    not_null=("id", "raw_payload", "error_reason", "failed_at", "inserted_at"), unique=("id",)
)
DEVICE_RISK = ModelTests(
    not_null=(
        "device_id", "total_events", "attack_events", "failed_events", "attack_rate", "failure_rate",
        "first_seen", "last_seen", "risk_level",
    ),
    unique=("device_id",),
    accepted={"risk_level": ("LOW", "MEDIUM", "HIGH")},
)
ATTACK_SUMMARY = ModelTests(
    not_null=("attack_type", "total_attack_events", "affected_devices", "first_seen", "last_seen")
)
PROTOCOL_METRICS = ModelTests(
    not_null=("protocol", "total_events", "attack_events", "failed_events", "attack_rate", "first_seen", "last_seen")
)
QUALITY_SUMMARY = ModelTests(not_null=("processed_records", "invalid_records", "total_records", "invalid_rate"))

MODELS: dict[str, ModelTests] = {
    "stg_processed_iot_logs": STAGED_PROCESSED,
    "stg_invalid_iot_logs": STAGED_INVALID,
    "mart_device_risk_summary": DEVICE_RISK,
    "mart_attack_summary": ATTACK_SUMMARY,
    "mart_protocol_metrics": PROTOCOL_METRICS,
    "mart_pipeline_quality_summary": QUALITY_SUMMARY,
}


def _result(model: str, columns: list[tuple[str, str]], row: DataFrame) -> DataFrame:
    """One wide row of failure counts to one row per test."""
    cells = [
        F.struct(
            F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"),
            F.col(f"{test}__{column}").alias("failures"),
        )
        for column, test in columns
    ]
    return row.select(F.inline(F.array(*cells)))


def not_null(df: DataFrame, model: str, tests: ModelTests) -> DataFrame:
    """Null counts of all columns in one pass."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"not_null__{c}") for c in tests.not_null]
    return _result(model, [(c, "not_null") for c in tests.not_null], df.agg(*counts))


def accepted_values(df: DataFrame, model: str, tests: ModelTests) -> DataFrame:
    """Rows outside the list, all columns in one pass; NULL passes."""
    counts = [F.count_if(~F.col(c).isin(*v)).alias(f"accepted_values__{c}") for c, v in tests.accepted.items()]
    return _result(model, [(c, "accepted_values") for c in tests.accepted], df.agg(*counts))


def unique(df: DataFrame, model: str, tests: ModelTests) -> DataFrame:
    """Number of values that occur more than once; NULLs are left out."""

    def one(column: str) -> DataFrame:
        repeated = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return _result(model, [(column, "unique")], repeated.agg(F.count_if(F.col("n") > 1).alias(f"unique__{column}")))

    return reduce(DataFrame.unionByName, [one(c) for c in tests.unique])


def run_model(df: DataFrame, model: str, tests: ModelTests) -> DataFrame:
    """All declared tests of one model; null and list checks share a single scan."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"not_null__{c}") for c in tests.not_null]
    counts += [F.count_if(~F.col(c).isin(*v)).alias(f"accepted_values__{c}") for c, v in tests.accepted.items()]
    columns = [(c, "not_null") for c in tests.not_null] + [(c, "accepted_values") for c in tests.accepted]
    result = _result(model, columns, df.agg(*counts))
    return result.unionByName(unique(df, model, tests)) if tests.unique else result


def run_all(models: dict[str, DataFrame], declared: dict[str, ModelTests] = MODELS) -> DataFrame:
    results = [run_model(models[name], name, tests) for name, tests in declared.items() if name in models]
    return reduce(DataFrame.unionByName, results).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail")
    )
