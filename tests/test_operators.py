"""Small frames for what the provided tables do not reach."""

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from emberlog.operators import anomalies, contract, data_tests, explore, features, manifest, marts, perf, quality, reconcile, runs, staging
from emberlog.sources import benchmark

LOG = (
    "id bigint, event_timestamp timestamp, device_id string, source_ip string, destination_ip string, protocol string, packet_size int, "
    "duration_ms int, event_type string, attack_type string, status string, ingestion_timestamp timestamp, processed_at timestamp, inserted_at timestamp"
)


def log_rows(spark, rows):
    """(id, device, protocol, size, span, event_type, label, status)."""
    df = spark.createDataFrame(rows, "id bigint, device_id string, protocol string, packet_size int, duration_ms int, event_type string, attack_type string, status string")
    moment = F.lit("2025-01-01T05:06:07.891Z").cast("timestamp")
    return df.withColumns(
        {"event_timestamp": moment, "processed_at": moment, "inserted_at": moment, "ingestion_timestamp": F.lit(None).cast("timestamp"),
         "source_ip": F.lit("1.1.1.1"), "destination_ip": F.lit("2.2.2.2")}
    )


def test_staging_flags_are_three_valued(spark):
    rows = log_rows(spark, [(1, " d ", " udp ", 1, 1, " ATTACK ", None, "ok"), (2, "d", "tcp", 1, 1, "normal", " label ", "FAILED"),
                            (3, "d", "tcp", 1, 1, None, "  ", None), (4, "d", "tcp", 1, 1, "normal", "", "success")])
    got = {r["id"]: r for r in staging.stage_processed(rows).collect()}
    assert [got[i]["is_attack"] for i in (1, 2, 3, 4)] == [True, True, None, False]
    assert [got[i]["is_failed"] for i in (1, 2, 3, 4)] == [False, True, None, False]
    assert got[1]["device_id"] == "d" and got[1]["protocol"] == "UDP" and got[1]["event_hour"] == 5 and got[3]["attack_type"] is None


@pytest.mark.parametrize(
    "reason,category",
    [("invalid JSON: x", "invalid_json"), ("missing required field: packet_size", "missing_required_field"), ("invalid timestamp", "invalid_timestamp"),
     ("event_timestamp must be a string", "other"), ("payload must be a JSON object", "other"), ("packet_size must be a non-negative integer", "invalid_packet_size"),
     ("invalid event_type", "invalid_event_type"), ("eventXtype odd", "invalid_event_type")],
)
def test_reason_category(spark, reason, category):
    assert spark.range(1).select(staging.category(F.lit(reason))).first()[0] == category


def test_rates_are_rounded_before_banding(spark):
    # 9999 of 20000 = 0.49995 rounds to 0.5000: HIGH
    staged = spark.range(20000).select(
        F.lit("d").alias("device_id"), F.lit("normal").alias("event_type"), (F.col("id") < 9999).alias("is_attack"), F.lit(False).alias("is_failed"),
        F.lit(1).alias("packet_size"), F.when(F.col("id") < 8, F.col("id").cast("int")).alias("duration_ms"), F.lit(0).cast("timestamp").alias("event_timestamp"),
    )
    row = marts.device_risk(staged).first()
    assert row["attack_rate"] == 0.5 and row["risk_level"] == "HIGH" and row["avg_duration_ms"] == 3.5


def test_empty_warehouse(spark):
    empty = spark.createDataFrame([], LOG)
    bad = spark.createDataFrame([], "id bigint, raw_payload string, error_reason string, failed_at timestamp, inserted_at timestamp")
    row = marts.quality_summary(staging.stage_processed(empty), staging.stage_invalid(bad)).first()
    assert (row["processed_records"], row["invalid_records"], row["invalid_rate"], row["last_processed_at"]) == (0, 0, 0.0, None)
    metrics = quality.run_metrics(empty, bad, "r")
    assert metrics.first()["invalid_rate"] == Decimal("0.000000")
    checks = {r["check_name"]: r for r in quality.quality_checks(metrics).collect()}
    assert checks["processed_records_present"]["severity"] == "high"
    assert checks["processed_records_present"]["message"] == "Processed record count 0 is below the minimum threshold of 1."
    assert checks["invalid_rate_threshold"]["message"] == "Invalid rate 0.000000 is within the threshold of 0.200000."
    alert = quality.alerts(quality.quality_checks(metrics), "2025-01-01").collect()
    assert [(a["alert_type"], a["alert_level"]) for a in alert] == [("processed_records_present", "critical")]
    assert quality.audit_rows(metrics, "2025-01-01", "2025-01-01").first()["status"] == "warning"
    assert anomalies.summary(empty).first()["anomalies_detected"] == 0
    assert explore.devices_per_risk(marts.device_risk(staging.stage_processed(empty))).count() == 3


def test_alert_payload(spark):
    metrics = spark.createDataFrame([("r", 3, 1, Decimal("0.250000"), 0)], "run_id string, processed_records bigint, invalid_records bigint, invalid_rate decimal(12,6), high_risk_devices bigint")
    raised = quality.alerts(quality.quality_checks(metrics), "2025-01-01T00:00:00Z")
    body = json.loads(quality.alert_payloads(raised, metrics).first()["value"])
    assert body["invalid_rate"] == 0.25 and body["created_at"] == "2025-01-01T00:00:00+00:00" and body["alert_level"] == "warning"


def test_rules_at_their_limits(spark):
    rows = log_rows(spark, [
        (1, "d", "tcp", 1500, 15000, "normal", "benign", "BLOCKED"), (2, "d", "tcp", 1499, 14999, "normal", "N/A", "error"),
        (3, "d", "mqtt", 999, 4999, "normal", "ARP_Poisioning", "success"), (4, "d", "icmp", None, None, "normal", " New_Thing ", None), (5, "d", None, 1, 1, None, None, "ok"),
    ])
    got = {(r["source_row_id"], r["rule_name"]): (r["severity"], r["score"], r["reason"]) for r in anomalies.detect(rows).collect()}
    assert got == {
        (1, "high_packet_size"): ("high", 90, "packet_size=1500 exceeds the high threshold of 1500 bytes."),
        (1, "high_duration"): ("high", 85, "duration_ms=15000 exceeds the high threshold of 15000 ms."),
        (1, "failed_or_blocked_status"): ("high", 95, "status=blocked indicates traffic that was blocked or denied."),
        (2, "high_packet_size"): ("medium", 70, "packet_size=1499 exceeds the review threshold of 1000 bytes."),
        (2, "high_duration"): ("medium", 65, "duration_ms=14999 exceeds the review threshold of 5000 ms."),
        (2, "failed_or_blocked_status"): ("medium", 75, "status=error indicates unsuccessful processing or failed traffic."),
        (3, "suspicious_attack_type"): ("high", 92, "attack_type=ARP_Poisioning matches a high-risk suspicious traffic label."),
        (3, "unusual_protocol"): ("high", 80, "protocol=MQTT is outside the expected set ['ICMP', 'TCP', 'UDP']."),
        (4, "suspicious_attack_type"): ("medium", 68, "attack_type=New_Thing is non-empty and marked for analyst review."),
        (4, "unusual_protocol"): ("low", 35, "protocol=ICMP is allowed but treated as less common control-plane traffic."),
    }
    row = anomalies.summary(rows).first()
    assert (row["rows_scanned"], row["anomalies_detected"], row["rows_with_anomalies"]) == (5, 10, 4)
    assert row["anomalies_by_severity"] == {"high": 5, "medium": 4, "low": 1}
    assert anomalies.detect(rows, rules=anomalies.Rules(packet_high=10_000, packet_review=9_000)).filter("rule_name = 'high_packet_size'").isEmpty()
    with pytest.raises(ValueError):
        anomalies.recent(rows, 0)


CONTRACT_COLUMNS = ", ".join(f"{c} string" for c in contract.RAW_LOG_CONTRACT) + ", n bigint"


def contract_rows(spark, changes):
    base = {"event_timestamp": "t", "device_id": "d", "source_ip": "a", "destination_ip": "b", "protocol": "mqtt", "packet_size": "1",
            "duration_ms": " 2 ", "event_type": "e", "attack_type": None, "status": "SUCCESS"}
    return spark.createDataFrame([tuple((base | c).values()) + (i + 2,) for i, c in enumerate(changes)], CONTRACT_COLUMNS)


def test_contract_messages(spark):
    df = contract_rows(spark, [{}, {"device_id": " "}, {"packet_size": "abc", "status": "odd"}, {"packet_size": "-1", "duration_ms": "1.5"}, {"protocol": "x'y"}])
    got = [r["error"] for r in contract.error_list(contract.check_rows(df, contract.RAW_LOG_CONTRACT, F.col("n"))).orderBy("row_number", "position").collect()]
    assert got == [
        "Row 3: column 'device_id' is required and cannot be empty.",
        "Row 4: column 'packet_size' expects an integer but got 'abc'",
        "Row 4: column 'status' has value 'odd' outside allowed values [success, failed, blocked, allowed, warning].",
        "Row 5: column 'packet_size' must be >= 0, got -1.",
        "Row 5: column 'duration_ms' expects an integer but got '1.5'",
        "Row 6: column 'protocol' has value 'x'y' outside allowed values [TCP, UDP, ICMP, HTTP, HTTPS, MQTT, ARP].",
    ]


@pytest.mark.parametrize(
    "cap,expected",
    [
        # rows_checked, valid, invalid, errors, stopped: errors are on rows 3 (1), 4 (2), 6 (1)
        (10, (6, 3, 3, 4, False)), (4, (6, 3, 3, 4, False)), (3, (5, 2, 3, 3, True)), (2, (3, 1, 2, 2, True)), (1, (3, 1, 2, 1, True)),
    ],
)
def test_contract_cap(spark, cap, expected):
    df = contract_rows(spark, [{}, {"device_id": ""}, {"device_id": "", "status": "x"}, {}, {"status": "x"}, {}])
    summary, errors = contract.run_contract(df, contract.RAW_LOG_CONTRACT, F.col("n"), cap)
    assert tuple(summary.select("rows_checked", "valid_rows", "invalid_rows", "error_count", "stopped_early").first()) == expected
    assert errors.count() == expected[3] and contract.status_code(summary) == 1
    with pytest.raises(contract.ContractError):
        contract.gate(summary)


def test_contract_missing_columns_and_bad_calls(spark):
    df = contract_rows(spark, [{}]).drop("status", "device_id")
    summary, errors = contract.run_contract(df, contract.RAW_LOG_CONTRACT, F.col("n"))
    assert tuple(summary.first()) == (0, 0, 0, 1, False)
    assert errors.first()["error"] == "Input CSV is missing required columns: device_id, status"
    with pytest.raises(contract.ContractError):
        contract.run_contract(contract_rows(spark, [{}]), contract.RAW_LOG_CONTRACT, F.col("n"), 0)
    contract.gate(contract.run_contract(contract_rows(spark, [{}]), contract.RAW_LOG_CONTRACT, F.col("n"))[0])


def test_contract_document(folder, spark):
    spec = {"schema": {"columns": {"n": {"required": True, "nullable": False, "logical_type": "Number", "validation": {"min": 2, "min_length": 2}}}}}
    with open(f"{folder}/c.json", "w") as out:
        json.dump(spec, out)
    rules = contract.load_contract(f"{folder}/c.json")
    df = spark.createDataFrame([("1.5", 2), ("x", 3), ("9", 4), (None, 5)], "n string, r bigint")
    got = [r["error"] for r in contract.error_list(contract.check_rows(df, rules, F.col("r"))).orderBy("row_number", "position").collect()]
    assert got == [
        "Row 2: column 'n' must be >= 2, got 1.5.", "Row 3: column 'n' must be at least 2 characters long.", "Row 3: column 'n' expects a number but got 'x'",
        "Row 4: column 'n' must be at least 2 characters long.", "Row 5: column 'n' is required and cannot be empty.",
    ]


def test_declared_tests_are_complete():
    assert sum(m.count() for m in data_tests.MODELS.values()) == 53
    assert sum(len(m.not_null) for m in data_tests.MODELS.values()) == 46


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id bigint")
    assert data_tests.unique(df, "m", data_tests.ModelTests((), ("id",))).first()["failures"] == 1


def test_filters_and_orders(spark):
    df = spark.createDataFrame([("a", "LOW", 0.1, 5), ("b", "HIGH", 0.6, 1), ("c", "ODD", 0.9, 9), ("d", "HIGH", 0.6, 2)], "device_id string, risk_level string, attack_rate double, total_events bigint")
    assert explore.filter_by_values(df, "risk_level", []).count() == 0
    assert explore.filter_by_values(df, "nothing", []).count() == 4
    assert [r["device_id"] for r in explore.top(df, explore.device_order(), 4).collect()] == ["d", "b", "a", "c"]
    assert [r["option"] for r in explore.options(df, "risk_level").collect()] == ["HIGH", "LOW"]
    latest = spark.createDataFrame([("r", "success", None, 1, None, None, None, "local")], "run_id string, status string, processed_records bigint, invalid_records bigint, high_risk_devices bigint, total_alerts bigint, invalid_rate decimal(12,6), environment string")
    row = explore.latest_run_numbers(latest).first()
    assert (row["processed_records"], row["invalid_rate"]) == (0, "0.00%")


def test_upsert_and_replace(spark):
    columns = "id bigint, run_id string, status string, created_at timestamp"
    at = lambda d: __import__("datetime").datetime(2025, 1, d)
    stored = spark.createDataFrame([(5, "a", "old", at(2)), (3, "a", "old", at(1)), (4, "b", "old", at(3))], columns)
    incoming = spark.createDataFrame([("a", "new"), ("c", "new")], "run_id string, status string")
    got = {r["run_id"]: tuple(r) for r in runs.upsert(stored, incoming, F.lit(9), F.lit(at(9))).collect()}
    assert got == {"a": (3, "a", "new", at(1)), "b": (4, "b", "old", at(3)), "c": (9, "c", "new", at(9))}
    assert runs.keep_first(stored).filter("run_id = 'a'").first()["id"] == 3
    emptied = runs.replace_runs(stored, stored.limit(0), incoming.select("run_id"))
    assert [r["run_id"] for r in emptied.collect()] == ["b"]


def test_manifest(spark):
    events = {
        "s3": ({"Records": [{"eventName": "Put", "s3": {"bucket": {"name": "b"}, "object": {"key": "raw/a+b%2Fc.CSV"}}}, {}]}, ("b", "raw/a b/c.CSV", "s3_event", 2, ".csv", "c.CSV", "raw/a b", "raw", "validated")),
        "direct": ({"bucket": "", "s3_bucket": "x", "s3_key": "top.jsonl"}, ("x", "top.jsonl", "direct_event", 1, ".jsonl", "top.jsonl", "", None, "validated")),
        "empty list": ({"Records": [], "key": "Curated /x.txt"}, (None, "Curated /x.txt", "direct_event", 1, ".txt", "x.txt", "Curated ", "curated", "invalid")),
        "hidden": ({"key": "/.csv"}, (None, "/.csv", "direct_event", 1, "", ".csv", "/", None, "invalid")),
        "no key": ({"bucket": "b"}, ("b", None, "direct_event", 1, None, None, None, None, "invalid")),
    }
    df = spark.createDataFrame([(n, json.dumps(e)) for n, (e, _) in events.items()] + [("text", '"x"')], "name string, event string")
    got = {r["name"]: r for r in manifest.validate(manifest.key_details(manifest.event_details(df))).collect()}
    for name, (_, expected) in events.items():
        r = got[name]
        assert (r["bucket"], r["object_key"], r["source_type"], r["record_count"], r["file_extension"], r["filename"], r["key_directory"], r["detected_layer"], r["status"]) == expected, name
    assert got["text"]["source_type"] == "unsupported_event" and got["no key"]["validation_errors"] == [manifest.MISSING_KEY]
    with pytest.raises(ValueError):
        manifest.branch(manifest.validate(manifest.key_details(manifest.event_details(df))), fail_on_invalid=True)


def run_document(**changes):
    step = {"name": "go-producer", "command": ["x"], "elapsed_seconds": 2, "return_code": None}
    body = {"timestamp": "t", "profile": "sample", "rows": 10, "consumer_messages": 1, "loader_messages": 1, "dry_run": False,
            "total_elapsed_seconds": 4.0, "commands": [step, step | {"name": "other", "elapsed_seconds": 2.0}]}
    return json.dumps(body | changes)


def test_run_documents(spark, folder):
    bad = {
        "a": ("{", "not valid JSON"), "b": ("[]", "root JSON object must be a dict."), "c": (run_document(rows=1.5), "rows must be an integer."),
        "d": (run_document(dry_run=1), "dry_run must be a boolean."), "e": (run_document(commands=[{"name": 1}]), "command.name must be a str."),
        "f": (run_document(commands=[{"name": "n", "command": [], "elapsed_seconds": 1, "return_code": "0"}]), "command.return_code must be an integer."),
        "g": (run_document(commands=[1]), "command entry must be a dict."),
    }
    for name, text in [*((n, t) for n, (t, _) in bad.items()), ("ok", run_document()), ("dry", run_document(dry_run=True, profile="full"))]:
        with open(f"{folder}/{name}.json", "w") as out:
            out.write(text)
    parsed = benchmark.parse(benchmark.documents(spark, folder)).persist()
    assert {r["file"]: r["message"] for r in benchmark.skipped(parsed).collect()} == {f"{n}.json": f"Skipped malformed file {n}.json: {m}" for n, (_, m) in bad.items()}
    good = benchmark.runs(parsed)
    table = {r["file"]: (r["throughput"], r["slowest_step"]) for r in perf.run_table(good).collect()}
    assert table == {"ok.json": ("2.50", "go-producer"), "dry.json": ("n/a", perf.DRY_RUN_STEP)}
    assert benchmark.runs(parsed, "full").count() == 1
    shares = {r["name"]: (r["elapsed_seconds"], r["share_percent"]) for r in perf.step_totals(good).collect()}
    assert shares == {"go-producer": (4.0, 50.0), "other": (4.0, 50.0), "python-consumer": (0.0, 0.0), "warehouse-loader": (0.0, 0.0)}
    row = perf.bottleneck(good).first()
    assert (row["dominant_step"], row["most_frequent_slowest"], row["real_runs"]) == ("go-producer", "go-producer", 1)
    nothing = good.filter("false")
    assert perf.bottleneck(nothing).isEmpty() and perf.overview(nothing).first()["run_count"] == 0
    assert {r["share_percent"] for r in perf.step_totals(nothing).collect()} == {0.0}


def test_reconcile(spark):
    counts = lambda p, i: spark.createDataFrame([(p, i)], "processed_count bigint, invalid_count bigint")
    assert reconcile.load_delta(counts(1, 1), counts(5, 2), 5).first()["status"] == "passed"
    assert reconcile.load_delta(counts(1, 1), counts(7, 0), 5).first()["status"] == "failed"
    assert reconcile.load_delta(counts(1, 1), counts(5, 2), 6).first()["status"] == "failed"
    results = spark.createDataFrame([("x", "passed", True), ("y", "failed", False), ("z", "dry_run", True), ("w", "unknown", True)], "name string, status string, required boolean")
    row = reconcile.status_rollup(results).first()
    assert row["other_statuses"] == 1
    assert (row["passed"], row["failed"], row["skipped"], row["dry_run"], row["overall_status"], row["required_failures"]) == (1, 1, 0, 1, "passed", "")
    timed = spark.createDataFrame([("data_contract_validation", 1.0, 1), ("anomaly_detection_read_only", 2.0, 2), ("anomaly_detection_read_only", 3.0, 3), ("profile_pipeline_post_run_postgres_counts", 4.0, 4)], "name string, duration_seconds double, position int")
    short = {r["stage"]: r["duration_seconds"] for r in reconcile.stage_durations(timed, full_run=False).collect()}
    assert short == {"data_contract_validation": 1.0, "anomaly_detection": 3.0}
    assert {r["stage"]: r["duration_seconds"] for r in reconcile.stage_durations(timed).collect()}["postgresql_verification"] == 4.0


def test_feature_input_guard_and_smoke_rows(spark):
    with pytest.raises(ValueError, match="Missing required columns in input: device_id, protocol"):
        features.normalize(spark.createDataFrame([("",) * 6], "event_timestamp string, packet_size string, duration_ms string, event_type string, attack_type string, status string"))
    rows = spark.createDataFrame([("d1", "MQTT", 120), ("d2", "HTTP", 80), ("d3", "MQTT", 200)], "device_id string, protocol string, bytes_sent bigint")
    assert [tuple(r) for r in features.protocol_volume(rows).orderBy("protocol").collect()] == [("HTTP", 1, 80), ("MQTT", 2, 320)]


def test_features_keep_unparsed_values_as_null(spark):
    names = "event_timestamp string, device_id string, protocol string, packet_size string, duration_ms string, event_type string, attack_type string, status string"
    rows = spark.createDataFrame([("2025-01-01T00:00:00Z", "d", "tcp", "10", "1.5", "normal", "", "success"), ("bad", "d", "udp", "x", None, "attack", " ", "error")], names)
    row = features.device_features(features.normalize(rows), ordered=True).first()
    assert (row["total_events"], row["avg_packet_size"], row["avg_duration_ms"], row["attack_event_ratio"], row["risk_level"]) == (2, 10.0, 1.5, 0.5, "high")
