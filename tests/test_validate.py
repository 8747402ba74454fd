"""Message rules: one message in, one reason (or none) out."""

import json

import pytest
from pyspark.sql import functions as F

from emberlog.functions import payload
from emberlog.operators import mapping, validate

NOW = "2025-01-02T03:04:05.678900Z"
GOOD = {
    "event_timestamp": "2025-01-01T00:00:00Z", "device_id": " dev_1 ", "source_ip": "10.0.0.1",
    "destination_ip": "10.0.0.2", "protocol": "udp", "packet_size": 118, "duration_ms": 1,
    "event_type": "Attack", "attack_type": "MQTT_Publish", "status": "Failed",
}


def text(**changes):
    body = {k: v for k, v in (GOOD | changes).items() if v is not ...}
    return json.dumps(body)


REASONS = {
    "good": (text(), None),
    "status absent": (text(status=...), "missing required field: status"),
    "blank device and absent status": (text(device_id=" \t", status=...), "missing required field: device_id; missing required field: status"),
    "missing stops type checks": (text(status="", packet_size=-1), "missing required field: status"),
    "bad time": (text(event_timestamp="not-a-timestamp"), "invalid timestamp"),
    "time is a number": (text(event_timestamp=20250101), "event_timestamp must be a string"),
    "time is null": (text(event_timestamp=None), "event_timestamp must be a string"),
    "year only": (text(event_timestamp="2025"), "invalid timestamp"),
    "month 13": (text(event_timestamp="2025-13-01"), "invalid timestamp"),
    "protocol http": (text(protocol="http"), "invalid protocol"),
    "protocol null": (text(protocol=None), "invalid protocol"),
    "size -1": (text(packet_size=-1), "packet_size must be a non-negative integer"),
    "span -5": (text(duration_ms=-5), "duration_ms must be a non-negative integer"),
    "size null": (text(packet_size=None), "packet_size must be a non-negative integer"),
    "size true": (text(packet_size=True), "packet_size must be a non-negative integer"),
    "size text true": (text(packet_size="true"), "packet_size must be a non-negative integer"),
    "size text fraction": (text(packet_size="3.7"), "packet_size must be a non-negative integer"),
    "size huge float": (text(packet_size=1).replace('"packet_size": 1', '"packet_size": 1e400'), "packet_size must be a non-negative integer"),
    "event type": (text(event_type="reboot"), "invalid event_type"),
    "all type errors": (
        text(event_timestamp="x", protocol="x", packet_size="x", duration_ms=-1, event_type="x"),
        "invalid timestamp; invalid protocol; packet_size must be a non-negative integer; "
        "duration_ms must be a non-negative integer; invalid event_type",
    ),
    "cut off": ('{"event_timestamp": ', validate.BAD_JSON),
    "empty": ("", validate.BAD_JSON),
    "text after the object": (text() + " x", validate.BAD_JSON),
    "two objects": (text() + text(), validate.BAD_JSON),
    "two listed objects": (text() + "," + text(), validate.BAD_JSON),
    "extra brace": (text() + "}", validate.BAD_JSON),
    "closes a bracket itself": (text() + "][{}", validate.BAD_JSON),
    "closes a brace itself": (text(status=...) + '}{"x":{}', validate.BAD_JSON),
    "brackets inside": (text(tags=["a", ["b"]]), None),
    "single quotes": (text().replace('"', "'"), validate.BAD_JSON),
    "array": ("[" + text() + "]", validate.NOT_OBJECT),
    "number": ("3", validate.NOT_OBJECT),
    "null": ("null", validate.NOT_OBJECT),
    "key of other case": (text(status=..., Status="ok"), "missing required field: status"),
    "surrounding space": ("\n " + text() + " \n", None),
    "fraction cut": (text(packet_size=3.7), None),
    "number in text": (text(packet_size=" +12 "), None),
    "null device": (text(device_id=None), None),
    "boolean status": (text(status=True), None),
    "nested device": (text(device_id={"a": 1}), None),
}


@pytest.fixture(scope="module")
def outcome(spark):
    rows = spark.createDataFrame([(n, t) for n, (t, _) in REASONS.items()], "name string, value string")
    return {r["name"]: r for r in validate.check(rows).collect()}


@pytest.mark.parametrize("name", REASONS)
def test_reason(outcome, name):
    assert outcome[name]["error_reason"] == REASONS[name][1]


def test_normalized_values(outcome):
    row = outcome["good"]
    assert (row["device_id"], row["protocol"], row["event_type"], row["status"]) == ("dev_1", "UDP", "attack", "failed")
    assert (row["packet_size"], row["attack_type"]) == (118, "MQTT_Publish")
    assert outcome["fraction cut"]["packet_size"] == 3
    assert outcome["number in text"]["packet_size"] == 12
    assert outcome["null device"]["device_id"] == "None"
    assert outcome["boolean status"]["status"] == "true"
    assert outcome["nested device"]["device_id"] == '{"a":1}'


@pytest.mark.parametrize(
    "given,utc",
    [
        ("2025-01-01T00:00:00Z", "2025-01-01T00:00:00Z"), ("2025-01-01", "2025-01-01T00:00:00Z"),
        ("2025-01-01 12:30", "2025-01-01T12:30:00Z"), ("2025-01-01T12:00:00+02:00", "2025-01-01T10:00:00Z"),
        ("2025-01-01T00:00:00.5Z", "2025-01-01T00:00:00.500000Z"), ("2025-01-01T00:00:00,25", "2025-01-01T00:00:00.250000Z"),
        (" 2025-01-01T00:00:00-0530 ", "2025-01-01T05:30:00Z"),
    ],
)
def test_time_spelling(spark, given, utc):
    rows = spark.createDataFrame([(text(event_timestamp=given),)], "value string")
    sent = json.loads(validate.processed_messages(validate.normalized(validate.check(rows), NOW)).first()["value"])
    assert sent["event_timestamp"] == utc


def test_outgoing_keeps_extra_fields_and_replaces_normalized(spark):
    body = text(sensor={"x": [1, None]}, note="a b", processed_at="old")
    rows = spark.createDataFrame([(1, body)], "position bigint, value string")
    row = validate.processed_messages(validate.normalized(validate.check(rows), NOW)).first()
    sent = json.loads(row["value"])
    assert row["key"] == "dev_1" and row["position"] == 1
    assert sent["sensor"] == {"x": [1, None]} and sent["note"] == "a b" and sent["attack_type"] == "MQTT_Publish"
    assert sent["processed_at"] == NOW and sent["packet_size"] == 118 and sent["status"] == "failed"


def test_bytes_and_missing_body(spark):
    rows = spark.createDataFrame([(bytearray(text().encode()),), (None,), (bytearray(b'{"a":\xff}'),)], "value binary")
    found = validate.check(rows).select("raw_text", "error_reason").collect()
    assert [r["error_reason"] for r in found] == [None, validate.BAD_JSON, validate.BAD_JSON]
    assert found[1]["raw_text"] == "None" and "�" in found[2]["raw_text"]


def test_repeated_key_takes_the_last_value(spark):
    body = text().replace('"protocol": "udp"', '"protocol": "bad", "protocol": "tcp"')
    row = validate.check(spark.createDataFrame([(body,)], "value string")).first()
    assert row["error_reason"] is None and row["protocol"] == "TCP"


def test_unusual_whitespace_is_stripped(spark):
    row = validate.check(spark.createDataFrame([(text(device_id="　d\t ", status=" "),)], "value string")).first()
    assert row["error_reason"] == "missing required field: status" and row["device_id"] == "d"


def test_dead_letter_keeps_payload_and_reason(spark):
    rows = spark.createDataFrame([("{oops",)], "value string")
    sent = json.loads(validate.rejected_messages(validate.rejected(validate.check(rows), NOW)).first()["value"])
    assert sent == {"raw_payload": "{oops", "error_reason": validate.BAD_JSON, "failed_at": NOW}


def test_split_is_a_partition(spark):
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(REASONS.values())], "position bigint, value string")
    checked = validate.check(rows)
    good, bad = validate.normalized(checked, NOW), validate.rejected(checked, NOW)
    assert good.count() + bad.count() == len(REASONS)
    out = validate.routed(rows, NOW)
    assert out.filter(F.col("topic") == validate.PROCESSED_TOPIC).count() == good.count()
    assert out.select("position").distinct().count() == len(REASONS)


def test_payload_kind(spark):
    rows = spark.createDataFrame([("{}",), ("[1]",), ("{",), ("{} {}",)], "value string")
    assert [r["payload_kind"] for r in payload.decode(rows).collect()] == ["object", "other", "bad_json", "bad_json"]


PROCESSED = json.loads(text()) | {"processed_at": "2025-01-01T00:00:01Z", "ingestion_timestamp": "2025-01-01T00:00:00Z"}


def _mapped(spark, **changes):
    body = json.dumps({k: v for k, v in (PROCESSED | changes).items() if v is not ...})
    return mapping.map_processed(spark.createDataFrame([(7, body)], "position bigint, value string"))


@pytest.mark.parametrize(
    "changes,problem",
    [
        ({}, None),
        ({"device_id": None}, "missing required field: device_id"),
        ({"device_id": "  "}, "missing required field: device_id"),
        ({"status": ...}, "missing required field: status"),
        ({"packet_size": True}, "packet_size must be an integer"),
        ({"packet_size": ...}, "packet_size must be an integer"),
        ({"packet_size": 2**31}, "packet_size is out of range for an integer column"),
        ({"event_timestamp": ...}, "missing required field: event_timestamp"),
        ({"event_timestamp": 5}, "event_timestamp must be a string"),
        ({"event_timestamp": " "}, "event_timestamp must not be empty"),
        ({"processed_at": "soon"}, "invalid timestamp for processed_at"),
        ({"ingestion_timestamp": "soon"}, "invalid timestamp for ingestion_timestamp"),
        ({"ingestion_timestamp": ""}, None),
        ({"ingestion_timestamp": ...}, None),
        ({"attack_type": ...}, None),
        ({"device_id": True}, None),
    ],
)
def test_mapping_problem(spark, changes, problem):
    assert _mapped(spark, **changes).first()["problem"] == problem


def test_mapped_row(spark):
    row = mapping.processed_rows(_mapped(spark, attack_type="  ", ingestion_timestamp=...), F.col("position"), NOW).first()
    assert row["id"] == 7 and row["attack_type"] is None and row["ingestion_timestamp"] is None
    assert row["packet_size"] == 118 and row["device_id"] == "dev_1" and json.loads(row["raw_payload"])["protocol"] == "udp"
    quarantined = mapping.quarantine_rows(_mapped(spark, packet_size="x"), F.col("position"), NOW).first()
    assert quarantined["reason"] == "packet_size must be an integer"


def test_invalid_mapping(spark):
    body = json.dumps({"raw_payload": "x", "error_reason": "y", "failed_at": "2025-01-01T00:00:00Z"})
    rows = spark.createDataFrame([(1, body), (2, "{}")], "position bigint, value string")
    mapped = mapping.map_invalid(rows)
    assert mapping.invalid_rows(mapped, F.col("position"), NOW).first()["error_reason"] == "y"
    assert mapping.quarantine_rows(mapped, F.col("position"), NOW).first()["reason"] == "missing required field: raw_payload"
