"""Runs that detect, store and announce: anomaly runs and the alerts of quality runs."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import anomalies, quality
from ..sinks import tables as sink
from ..sources import tables, topics


class UndeliveredError(RuntimeError):
    """Alerts that did not reach their topic."""


def generated_run_id(now: datetime | None = None) -> str:
    """Run id of an anomaly run that was given none."""
    return (now or datetime.now(timezone.utc)).strftime("anomaly-detection-%Y%m%dT%H%M%SZ")


def anomaly_run(
    rows: DataFrame, root: str, now: Column | str, run_id: str | None = None, write: bool = False,
    limit: int | None = None, rules: anomalies.Rules = anomalies.Rules(),
) -> DataFrame:
    """One summary row of an anomaly run. Findings are stored only when asked; without it the run is dry."""
    run = run_id or generated_run_id()
    inserted = 0
    if write:
        found = anomalies.store_form(anomalies.detect(rows, limit, rules), run, now)
        inserted = sink.append_numbered(found, root, "iot_anomalies")
    counted = anomalies.summary(rows, limit, rules)
    return counted.select(
        F.lit(run).alias("run_id"), F.lit(not write).alias("dry_run"), F.lit(write).alias("write_db"),
        "rows_scanned", "anomalies_detected", "rows_with_anomalies", F.lit(inserted).cast("bigint").alias("inserted_rows"),
        "anomalies_by_rule", "anomalies_by_severity",
    )


def publish_alerts(
    spark: SparkSession, tables_root: str, topic_root: str, run_id: str, metrics: DataFrame, now: Column | str,
    settings: quality.RunSettings = quality.RunSettings(), max_bytes: int = topics.MAX_BYTES,
) -> int:
    """Send the stored alerts of a run to the alert topic, then flag them; a rerun sends them again.

    The flag is set after the topic is complete, so alerts may be sent twice but never lost: an alert that the
    topic does not hold afterwards is an error, and none of the run is flagged.
    """
    alerts = tables.read(spark, tables_root, "pipeline_alerts").filter(F.col("run_id") == run_id)
    payloads = quality.alert_payloads(alerts, metrics, settings).withColumn("key", F.lit(None).cast("string"))
    result = topics.publish(payloads, topic_root, topics.ALERT_TOPIC, max_bytes=max_bytes).first()
    if result["failed"]:
        raise UndeliveredError(f"{result['failed']} of {result['sent'] + result['failed']} alerts of run {run_id} were not delivered")
    if result["sent"]:
        sink.mark_published(spark, tables_root, run_id, now)
    return result["sent"]
