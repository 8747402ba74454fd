"""Run-level quality: metrics, threshold checks, alerts and the audit row.

Every function works on frames that carry ``run_id``, one run or many at a time.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock
from ..functions.numeric import quantize, ratio


@dataclass(frozen=True)
class RunSettings:
    """Fixed defaults of a quality run."""

    pipeline_name: str = "iot_local_pipeline"
    environment: str = "local"
    invalid_rate_threshold: Decimal = Decimal("0.20")
    min_processed_records: int = 1
    source: str = "observability_writer"

    def __post_init__(self):
        for name in ("pipeline_name", "environment"):
            if not getattr(self, name).strip():
                raise ValueError(f"{name} cannot be empty")
        if self.invalid_rate_threshold < 0 or self.min_processed_records < 0:
            raise ValueError("thresholds must be zero or greater")


def _metrics(counts: DataFrame) -> DataFrame:
    total = F.col("processed_records") + F.col("invalid_records")
    share = ratio(F.col("invalid_records"), total, 6)
    return counts.select(
        "run_id", "processed_records", "invalid_records",
        quantize(F.coalesce(share, F.lit(Decimal(0))), 12).alias("invalid_rate"),
        # not measured by the run writer; stored as 0
        F.lit(0).cast("bigint").alias("high_risk_devices"),
    )


def run_metrics(processed: DataFrame, invalid: DataFrame, run_id: str) -> DataFrame:
    """One row for the two warehouse tables as they stand."""
    good = processed.agg(F.count(F.lit(1)).alias("processed_records"))
    bad = invalid.agg(F.count(F.lit(1)).alias("invalid_records"))
    return metrics_of(good.crossJoin(F.broadcast(bad)), run_id)


def metrics_of(totals: DataFrame, run_id: str) -> DataFrame:
    """``run_metrics`` from one row with both counts."""
    if not run_id.strip():
        raise ValueError("run_id cannot be empty")
    return _metrics(totals.withColumn("run_id", F.lit(run_id)))


def metrics_by_run(outcomes: DataFrame, run_id: Column, is_valid: Column) -> DataFrame:
    """One row per run from labelled outcomes, one aggregation for all runs."""
    return _metrics(
        outcomes.groupBy(run_id.alias("run_id")).agg(
            F.count_if(is_valid).alias("processed_records"), F.count_if(~is_valid).alias("invalid_records")
        )
    )


def with_checks(metrics: DataFrame, settings: RunSettings = RunSettings()) -> DataFrame:
    """Metrics plus the two check results as an array: the audit row can count failures from it
    without joining the exploded checks back."""
    least = f"cast({settings.min_processed_records} AS bigint)"
    limit = f"cast({settings.invalid_rate_threshold} AS decimal(12,6))"
    checks = (
        ("processed_records_present", "processed_records", ">=", least, "high", "Processed record count ", " meets", " is below", "minimum threshold"),
        ("invalid_rate_threshold", "invalid_rate", "<=", limit, "medium", "Invalid rate ", " is within", " exceeds", "threshold"),
    )
    structs = [
        f"named_struct('check_name', '{name}', "
        f"'check_status', if({metric} {test} {bound}, 'pass', 'fail'), "
        f"'severity', if({metric} {test} {bound}, 'low', '{on_fail}'), "
        f"'metric_name', '{metric}', "
        f"'metric_value', cast({metric} AS decimal(18,6)), 'threshold_value', cast({bound} AS decimal(18,6)), "
        f"'message', concat('{lead}', {metric}, if({metric} {test} {bound}, '{good}', '{bad}'), ' the {noun} of ', {bound}, '.'))"
        for name, metric, test, bound, on_fail, lead, good, bad, noun in checks
    ]
    return metrics.selectExpr("*", f"array({', '.join(structs)}) AS checks")


def quality_checks(metrics: DataFrame, settings: RunSettings = RunSettings()) -> DataFrame:
    return with_checks(metrics, settings).select("run_id", F.inline("checks"))


def alerts(checks: DataFrame, created_at: Column | str, settings: RunSettings = RunSettings()) -> DataFrame:
    """One alert per failed check; only a high severity is critical."""
    return checks.filter(F.col("check_status") != "pass").select(
        "run_id",
        F.col("check_name").alias("alert_type"),
        F.when(F.col("severity").isin("low", "medium"), "warning").otherwise("critical").alias("alert_level"),
        F.col("message").alias("alert_message"),
        F.lit(settings.source).alias("source"),
        F.lit(False).alias("is_published_to_kafka"),
        clock.moment(created_at).alias("created_at"),
    )


def audit_rows(
    metrics: DataFrame, started_at: Column | str, finished_at: Column | str, settings: RunSettings = RunSettings()
) -> DataFrame:
    failing = F.size(F.filter("checks", lambda c: c["check_status"] != "pass")).cast("bigint")
    return with_checks(metrics, settings).select(
        "run_id",
        F.lit(settings.pipeline_name).alias("pipeline_name"),
        F.lit(settings.environment).alias("environment"),
        clock.moment(started_at).alias("started_at"),
        clock.moment(finished_at).alias("finished_at"),
        F.when(failing == 0, "success").otherwise("warning").alias("status"),
        "processed_records", "invalid_records", "invalid_rate", "high_risk_devices",
        failing.alias("total_alerts"),
    )


def alert_payloads(alert_rows: DataFrame, metrics: DataFrame, settings: RunSettings = RunSettings()) -> DataFrame:
    """Outgoing alert messages: alert, run settings and the run's metrics as one JSON object."""
    # offset spelling of the payload: +00:00 instead of Z
    created = F.expr(f"replace({clock.iso_micros('created_at')}, 'Z', '+00:00')")
    body = F.struct(
        "run_id",
        F.lit(settings.pipeline_name).alias("pipeline_name"),
        F.lit(settings.environment).alias("environment"),
        "alert_type", "alert_level", "alert_message", "source", "processed_records", "invalid_records",
        F.col("invalid_rate").cast("double").alias("invalid_rate"),
        created.alias("created_at"),
    )
    measured = metrics.select("run_id", "processed_records", "invalid_records", "invalid_rate")
    return alert_rows.join(measured, "run_id").select("run_id", "alert_type", F.to_json(body).alias("value"))


def assert_written(audit: DataFrame, checks: DataFrame, run_id: str) -> None:
    """After a run is stored: exactly one audit row and at least two check rows for it."""
    mine = F.col("run_id") == run_id
    audits, rows = audit.filter(mine).count(), checks.filter(mine).count()
    if audits != 1:
        raise RuntimeError(f"expected one audit row for run '{run_id}', found {audits}")
    if rows < 2:
        raise RuntimeError(f"expected at least two quality checks for run '{run_id}', found {rows}")
