"""Declared schemas of topics, warehouse tables and run documents (DDL text)."""

from __future__ import annotations

from pyspark.sql.types import StructType

# wide enough for any batch number beside a 64-bit row number
POSITION = "decimal(38,0)"

TOPIC = f"position {POSITION}, key string, value string, batch_id bigint, topic string"

PROCESSED_LOGS = (
    "id bigint, event_timestamp timestamp, device_id string, source_ip string, destination_ip string, "
    "protocol string, packet_size int, duration_ms int, event_type string, attack_type string, status string, "
    "ingestion_timestamp timestamp, processed_at timestamp, raw_payload string, inserted_at timestamp"
)
INVALID_LOGS = "id bigint, raw_payload string, error_reason string, failed_at timestamp, inserted_at timestamp"
QUARANTINE = "id bigint, raw_text string, reason string, inserted_at timestamp"
# a batch as one write holds it: the columns of all three tables, and the table a row belongs to
LOADED = (
    "id bigint, event_timestamp timestamp, device_id string, source_ip string, destination_ip string, protocol string, packet_size int, "
    "duration_ms int, event_type string, attack_type string, status string, ingestion_timestamp timestamp, processed_at timestamp, "
    "raw_payload string, error_reason string, failed_at timestamp, raw_text string, reason string, inserted_at timestamp"
)
# markers of finished batches: the attempt that counts, its rows by table, and the last id of each table so far
LOADS = (
    "batch_id bigint, attempt string, processed_rows bigint, invalid_rows bigint, quarantined_rows bigint, "
    "last_processed_id bigint, last_invalid_id bigint, last_quarantine_id bigint"
)
# finished writes of run tables; from a replacing version on, earlier versions of the run no longer count
VERSIONS = "table_name string, run_id string, version string, replaces boolean"
# next offset to read of a consumer group
OFFSETS = "group_id string, topic string, partition bigint, next_offset bigint"

ANOMALIES = (
    "id bigint, source_row_id string, event_timestamp timestamp_ntz, device_id string, rule_name string, severity string, "
    "reason string, score decimal(38,18), created_at timestamp_ntz, run_id string"
)
RUN_AUDIT = (
    "id bigint, pipeline_name string, environment string, started_at timestamp, finished_at timestamp, status string, "
    "processed_records bigint, invalid_records bigint, invalid_rate decimal(12,6), high_risk_devices bigint, "
    "total_alerts bigint, created_at timestamp, run_id string"
)
QUALITY_CHECKS = (
    "id bigint, check_name string, check_status string, severity string, metric_name string, "
    "metric_value decimal(18,6), threshold_value decimal(18,6), message string, created_at timestamp, run_id string"
)
ALERTS = (
    "id bigint, alert_type string, alert_level string, alert_message string, source string, "
    "is_published_to_kafka boolean, created_at timestamp, run_id string"
)

# versions of a run's alerts that were sent; the published flag of an alert is read from here
PUBLICATIONS = "alerts_version string, published_at timestamp, run_id string"

LOADED_TABLES = ("processed_iot_logs", "invalid_iot_logs", "load_quarantine")
TABLES = {
    "processed_iot_logs": PROCESSED_LOGS,
    "invalid_iot_logs": INVALID_LOGS,
    "load_quarantine": QUARANTINE,
    "iot_anomalies": ANOMALIES,
    "pipeline_run_audit": RUN_AUDIT,
    "pipeline_quality_checks": QUALITY_CHECKS,
    "pipeline_alerts": ALERTS,
    "pipeline_alert_publications": PUBLICATIONS,
}


def column_names(ddl: str) -> list[str]:
    """Names of a schema; needs a running session, whose parser reads it."""
    return StructType.fromDDL(ddl).names
