"""One whole run in order: gate, truncate, ingest, validate, load, reconcile, anomalies, models, tests, features, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import contract, data_tests, features, marts, quality, reconcile, staging, validate
from ..sinks import files, tables as sink
from ..sources import csv, tables, topics
from ..streaming import jobs
from . import quality_run


def run(
    spark: SparkSession,
    logs: DataFrame,
    root: str,
    run_id: str,
    now: str,
    row_number=None,
    settings: quality.RunSettings = quality.RunSettings(),
    stop_on_contract_errors: bool = True,
) -> DataFrame:
    """Run every stage once and return one row per stage with its row count.

    ``logs`` are raw text rows; ``row_number`` (a column) is needed for contract messages. A failing
    stage raises and nothing after it runs.
    """
    at = jobs.run_folders(root, run_id)
    steps: list[tuple[str, int]] = []

    number = row_number if row_number is not None else F.col("row_number")
    summary, errors = contract.run_contract(logs, contract.RAW_LOG_CONTRACT, number)
    files.write_contract_report(summary, errors, f"{at['reports']}/contract", "logs", "raw logs", now)
    report = spark.read.schema("rows_checked bigint, invalid_rows bigint, error_count bigint").json(f"{at['reports']}/contract/summary")
    if stop_on_contract_errors:
        contract.gate(report)
    steps.append(("contract_errors", report.first()["error_count"]))
    steps.append(("reported_errors", spark.read.schema("row_number bigint").json(f"{at['reports']}/contract/errors").count()))

    sink.truncate(spark, at["tables"])
    before = _table_counts(spark, at["tables"])

    typed = logs.withColumns({c: F.expr(f"try_cast({c} AS int)") for c in ("packet_size", "duration_ms")})
    accepted = typed.filter("packet_size IS NOT NULL AND duration_ms IS NOT NULL").select(*csv.COLUMNS)
    sent = topics.publish(csv.messages(accepted, now), at["raw_topic"], topics.RAW_TOPIC)
    offered = sent.first()
    if offered["failed"]:
        raise RuntimeError(f"{offered['failed']} raw messages were not sent")
    steps.append(("raw_messages", offered["sent"]))

    checked, loaded = jobs.Counters(), jobs.Counters()
    outgoing = [validate.PROCESSED_TOPIC, validate.INVALID_TOPIC]
    jobs.run_sequential(
        [
            lambda: jobs.start_validator(
                topics.stream(spark, at["raw_topic"], [topics.RAW_TOPIC]), at["topics"], at["validator_checkpoint"], counters=checked, now=now
            ),
            lambda: jobs.start_loader(
                topics.stream(spark, at["topics"], outgoing), at["tables"], at["loader_checkpoint"], counters=loaded, now=now
            ),
        ]
    )
    steps += [("processed_rows", loaded.totals.get("processed", 0)), ("invalid_rows", loaded.totals.get("invalid", 0))]

    processed = tables.read_loaded(spark, at["tables"], "processed_iot_logs")
    invalid = tables.read_loaded(spark, at["tables"], "invalid_iot_logs")

    delta = reconcile.load_delta(before, _table_counts(spark, at["tables"]), offered["sent"]).first()
    if delta["status"] != "passed":
        raise RuntimeError(f"{delta['total_delta']} rows were loaded instead of {delta['expected_rows']}")
    steps.append(("reconciled_rows", delta["total_delta"]))

    detection = f"{run_id}-anomalies"
    detected = quality_run.anomaly_run(processed, at["tables"], now, detection, write=True)
    stored_findings = tables.read(spark, at["tables"], "iot_anomalies").filter(F.col("run_id") == detection)
    # the report lists what was stored
    totals = detected.select("rows_scanned", "anomalies_detected", "rows_with_anomalies", "anomalies_by_rule", "anomalies_by_severity")
    files.write_anomaly_report(totals, stored_findings, f"{at['reports']}/anomalies", detection, None, "write-db", now)
    steps.append(("anomalies", detected.first()["inserted_rows"]))
    steps.append(("reported_anomalies", spark.read.schema("source_row_id string").json(f"{at['reports']}/anomalies/anomalies").count()))

    # staged rows feed four marts and the tests: computed once, read back from storage
    staged, staged_invalid = (
        _stored(spark, frame, f"{at['tables']}/{name}")
        for name, frame in (("stg_processed_iot_logs", staging.stage_processed(processed)), ("stg_invalid_iot_logs", staging.stage_invalid(invalid)))
    )
    models = {"stg_processed_iot_logs": staged, "stg_invalid_iot_logs": staged_invalid}
    for name, mart in (
        ("mart_device_risk_summary", marts.device_risk(staged)),
        ("mart_attack_summary", marts.attack_summary(staged)),
        ("mart_protocol_metrics", marts.protocol_metrics(staged)),
        ("mart_pipeline_quality_summary", marts.quality_summary(staged, staged_invalid)),
    ):
        models[name] = _stored(spark, mart, f"{at['tables']}/{name}")
        steps.append((name, models[name].count()))
    results = data_tests.run_all(models)
    steps.append(("failed_tests", results.filter("status = 'fail'").count()))

    vectors = features.device_features(features.normalize(logs, timestamp_format=None))
    listing = files.publish(vectors, at["features"], "spark/device_features/latest")
    if listing.isEmpty():
        raise RuntimeError("no feature files were published")
    steps.append(("feature_rows", spark.read.parquet(f"{at['features']}/spark/device_features/latest").count()))

    needed = {"processed_iot_logs": processed, "invalid_iot_logs": invalid} | {
        name: tables.read(spark, at["tables"], name) for name in ("pipeline_run_audit", "pipeline_quality_checks", "pipeline_alerts")
    }
    tables.require_schema(needed)
    metrics = quality.run_metrics(processed, invalid, run_id)
    checks = quality.quality_checks(metrics, settings)
    sink.upsert_audit(quality.audit_rows(metrics, now, now, settings), at["tables"], run_id, now)
    sink.replace_numbered(checks.withColumn("created_at", F.lit(now).cast("timestamp")), at["tables"], "pipeline_quality_checks", run_id, "check_name")
    raised = quality.alerts(checks, now, settings)
    sink.replace_alerts(raised, at["tables"], run_id)
    stored = {n: tables.read(spark, at["tables"], n) for n in ("pipeline_run_audit", "pipeline_quality_checks", "pipeline_alerts")}
    quality_run.publish_alerts(spark, at["tables"], at["topics"] + "_alerts", run_id, metrics, now, settings)
    quality.assert_written(stored["pipeline_run_audit"], stored["pipeline_quality_checks"], run_id)
    steps.append(("quality_checks", stored["pipeline_quality_checks"].count()))
    return spark.createDataFrame(steps, "stage string, row_count bigint")


def _table_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows of both tables from the markers of the finished loads, as one row."""
    counts = tables.finished_loads(spark, root).agg(F.sum("processed_rows").alias("p"), F.sum("invalid_rows").alias("i")).first()
    return spark.createDataFrame([(counts["p"] or 0, counts["i"] or 0)], "processed_count bigint, invalid_count bigint")


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
