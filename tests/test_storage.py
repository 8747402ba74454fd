"""Files, topics, tables and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from emberlog import schemas
from emberlog.functions import ordering
from emberlog.operators import anomalies, contract, mapping, quality, runs, sampling, validate
from emberlog.plans import bridge, full_run
from emberlog.sinks import files, tables as sink
from emberlog.sources import csv, tables, topics
from emberlog.streaming import jobs

NOW = "2025-01-01T12:00:00Z"
SF = "/root/testdata/sf0.001"
HEADER = ",".join(csv.COLUMNS)


def line(size="10", span="5", last="success", **k):
    return f"2025-01-01T00:00:00Z, {k.get('device', 'd1')} ,1.1.1.1,2.2.2.2,tcp,{size},{span},normal,,{last}"


def write(path, *lines, head=HEADER):
    with open(path, "w", encoding="utf-8") as out:
        out.write("\n".join([head, *lines]) + "\n")
    return path


def test_lenient_scan(spark, folder):
    head = "﻿" + ", ".join(f'"{c}"' if i else f'"{c}"' for i, c in enumerate(csv.COLUMNS)).replace(", ", ",")
    path = write(f"{folder}/a.csv", line(), line(size="invalid"), line(span=" 7 "), line().rsplit(",", 1)[0], line() + ",extra,more", line(last=""), head=head)
    accepted, skipped = csv.scan_lenient(spark, path)
    rows = sorted(accepted.collect(), key=lambda r: r["_seq"])
    assert [r["duration_ms"] for r in rows] == [5, 7, 5, 5] and [r["status"] for r in rows] == ["success", "success", "success", ""]
    assert rows[0]["device_id"] == "d1" and rows[0]["packet_size"] == 10
    assert skipped.get["skipped_rows"] == 2
    assert csv.cap_rows(accepted, 2).count() == 2 and csv.cap_rows(accepted, 0).count() == 4
    sent = json.loads(csv.messages(accepted, NOW).first()["value"])
    assert sent["ingestion_timestamp"] == NOW and sent["packet_size"] == 10 and list(sent)[:2] == ["event_timestamp", "device_id"]


def test_columns_in_any_order_and_missing_column(spark, folder):
    moved = write(f"{folder}/b.csv", "success,," + line().rsplit(",,", 1)[0], head="status,attack_type," + ",".join(csv.COLUMNS[:-2]))
    assert csv.scan_lenient(spark, moved)[0].first()["status"] == "success"
    lost = write(f"{folder}/c.csv", "x", head="device_id")
    with pytest.raises(ValueError, match='missing required csv column "event_timestamp"'):
        csv.scan_lenient(spark, lost)


def test_every_file_is_read_by_its_own_header(spark, folder):
    write(f"{folder}/a.csv", line(device="d1"), "short,row")
    swapped = list(csv.COLUMNS)
    swapped[1], swapped[2] = swapped[2], swapped[1]
    write(f"{folder}/b.csv", line(device="2.2.2.2").replace("1.1.1.1", "d2"), line(size="x"), head="\ufeff" + ",".join(swapped))
    open(f"{folder}/empty.csv", "w").close()
    accepted, skipped = csv.scan_lenient(spark, folder)
    assert {(r["device_id"], r["source_ip"]) for r in accepted.collect()} == {("d1", "1.1.1.1"), ("d2", "2.2.2.2")}
    assert skipped.get["skipped_rows"] == 2
    texts = csv.scan_text(spark, f"{folder}/b.csv").unionByName(csv.scan_text(spark, f"{folder}/a.csv"))
    assert {r["device_id"] for r in texts.collect()} >= {"d2", " d1 "}
    assert csv.scan_strict(spark, f"{folder}/b.csv").first()["device_id"] == "d2"


def test_all_alerts_of_a_run_are_published(spark, folder):
    raised = spark.range(1500).select(
        F.format_string("kind-%05d", "id").alias("alert_type"), F.lit("warning").alias("alert_level"), F.lit("m").alias("alert_message"),
        F.lit("s").alias("source"), F.lit(False).alias("is_published_to_kafka"), F.lit(NOW).cast("timestamp").alias("created_at"), F.lit("r").alias("run_id"),
    )
    sink.replace_alerts(raised, folder, "r")
    sink.mark_published(spark, folder, "r", NOW)
    alerts = tables.read(spark, folder, "pipeline_alerts")
    assert alerts.count() == 1500 and alerts.filter("is_published_to_kafka").count() == 1500
    sink.replace_alerts(raised.limit(3), folder, "r")
    assert [r["is_published_to_kafka"] for r in tables.read(spark, folder, "pipeline_alerts").collect()] == [False] * 3


def test_strict_scan(spark, folder):
    good = csv.scan_strict(spark, write(f"{folder}/a.csv", line()))
    assert good.count() == 1
    ragged = csv.scan_strict(spark, write(f"{folder}/b.csv", line(), "a,b"))
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        ragged.count()


def test_profiles():
    assert csv.input_path(" Medium ").endswith("medium_iot_logs.csv") and csv.input_path("full", "x.csv") == "x.csv"
    with pytest.raises(ValueError, match="allowed values are sample, medium, full"):
        csv.input_path("huge")


def test_contract_over_a_file(spark, folder):
    path = write(f"{folder}/a.csv", line(), line(size="-1"), line(device=" "))
    df = csv.scan_text(spark, path)
    _, errors = contract.run_contract(df, contract.RAW_LOG_CONTRACT, F.col("row_number"))
    assert [r["error"][:6] for r in errors.orderBy("row_number").collect()] == ["Row 3:", "Row 4:"]
    summary, errors = contract.run_contract(df, contract.RAW_LOG_CONTRACT, F.col("row_number"), 1)
    files.write_contract_report(summary, errors, f"{folder}/report", path, "contract", NOW)
    report = spark.read.json(f"{folder}/report/summary").first()
    assert report["rows_checked"] == 3 and spark.read.json(f"{folder}/report/errors").count() == 1


def test_subset_refuses_to_overwrite(spark, folder):
    df = sampling.normalize_header(spark.createDataFrame([("1",)], '`﻿"a" ` string'))
    assert df.columns == ["a"]
    files.write_subset(df, f"{folder}/out")
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_subset(df, f"{folder}/out")
    files.write_subset(df, f"{folder}/out", overwrite=True)
    with pytest.raises(ValueError, match="different"):
        files.write_subset(spark.read.csv(f"{folder}/out", header=True), f"{folder}/out", overwrite=True)


def test_publish_features(spark, folder):
    listing = files.publish(spark.range(5).repartition(2), f"{folder}/bucket", "/spark/latest/").collect()
    assert all(r["object_key"].startswith("spark/latest/part-") for r in listing)
    with pytest.raises(FileNotFoundError):
        tables.parquet_files(spark, f"{folder}/nothing")


def test_table_guards(spark):
    with pytest.raises(RuntimeError, match="required table 'processed_iot_logs' does not exist"):
        tables.require_schema({})
    needed = {n: cols or schemas.column_names(schemas.TABLES[n]) for n, cols in tables.NEEDED.items()}
    frames = {n: spark.createDataFrame([], ", ".join(f"{c} string" for c in cols)) for n, cols in needed.items()}
    tables.require_schema(frames)
    with pytest.raises(RuntimeError, match="table 'pipeline_alerts' is missing required columns: id, source"):
        tables.require_schema(frames | {"pipeline_alerts": frames["pipeline_alerts"].drop("source", "id")})
    assert tables.missing_tables(spark, ["no_such_table"]) == ["no_such_table"]
    got, errors = tables.load_frames(spark, ["no_such_table"])
    assert got["no_such_table"].isEmpty() and errors == {"no_such_table": "missing"}


def test_catalog_tables(spark, folder):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS ember_test LOCATION '{folder}/db'")
    try:
        for _ in range(2):
            sink.create_if_missing(spark, "ember_test.iot_anomalies", "iot_anomalies")
            sink.materialize({"mart": spark.range(3)}, prefix="ember_test.")
        assert spark.table("ember_test.iot_anomalies").isEmpty() and spark.table("ember_test.mart").count() == 3
        frames, errors = tables.load_frames(spark, ["ember_test.mart", "ember_test.none"])
        assert frames["ember_test.mart"].count() == 3 and frames["ember_test.none"].isEmpty() and errors == {"ember_test.none": "missing"}
        assert tables.missing_tables(spark, ["ember_test.mart", "ember_test.none"]) == ["ember_test.none"]
        assert tables.preview(spark.table("ember_test.mart"), 2).count() == 2
    finally:
        spark.sql("DROP DATABASE ember_test CASCADE")


def test_anomaly_table_and_report(spark, folder):
    rows = bridge.processed(spark, SF)
    found = anomalies.detect(rows, limit=200)
    for run in ("r1", "r2"):
        assert sink.append_numbered(anomalies.store_form(found, run, NOW).repartition(3), folder, "iot_anomalies") == found.count()
    stored = tables.read(spark, folder, "iot_anomalies")
    assert sorted(r["id"] for r in stored.select("id").collect()) == list(range(1, 2 * found.count() + 1))
    assert stored.count() == 2 * found.count() and anomalies.per_run(stored).count() == 2
    assert anomalies.latest_run(stored).first()["run_id"] == "r2"
    files.write_anomaly_report(anomalies.summary(rows, 200), found, f"{folder}/report", "r1", 200, "read-only", NOW)
    report = spark.read.json(f"{folder}/report/summary").first()
    assert report["summary"]["rows_scanned"] == 200 and report["summary"]["anomalies_detected"] == found.count()
    assert spark.read.json(f"{folder}/report/anomalies").count() == found.count()


def test_kafka_options():
    assert topics.kafka_read_options("h:1", ["a", "b"], 9) == {"kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "9"}
    assert topics.kafka_write_options("h:1", "t")["topic"] == "t"


def test_positions_are_unique(spark, folder):
    frame = spark.range(1000).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value")).repartition(5)
    for batch in (0, 70_000, 2**40):
        assert topics.publish(frame, folder, "t", batch).first()["sent"] == 1000
    assert topics.read(spark, folder, ["t"]).select("position").distinct().count() == 3000
    # row numbers of tasks above 131,072 keep all their bits
    high = spark.range(1).select((topics.position(70_000) - F.monotonically_increasing_id() + F.lit((200_000 << 33) + 5)).alias("p")).first()["p"]
    assert high == 70_000 * 2**63 + (200_000 << 33) + 5


def metrics(spark, run, good, bad):
    df = spark.createDataFrame([(good, bad)], "processed_records bigint, invalid_records bigint")
    return quality._metrics(df.withColumn("run_id", F.lit(run)))


def test_run_tables(spark, folder):
    settings = quality.RunSettings()

    def store(run, good, bad, now):
        m = metrics(spark, run, good, bad)
        checks = quality.quality_checks(m, settings)
        sink.upsert_audit(quality.audit_rows(m, now, now, settings), folder, run, now)
        sink.replace_numbered(checks.withColumn("created_at", F.lit(now).cast("timestamp")), folder, "pipeline_quality_checks", run, "check_name")
        sink.replace_alerts(quality.alerts(checks, now, settings), folder, run)

    run = "manual: run/1 ü"
    store(run, 1, 9, "2025-01-01")
    store("other", 9, 1, "2025-01-02")
    audit = lambda: {r["run_id"]: r for r in tables.read(spark, folder, "pipeline_run_audit").collect()}
    alerts = lambda: tables.read(spark, folder, "pipeline_alerts").filter(F.col("run_id") == run)
    assert audit()[run]["status"] == "warning" and alerts().count() == 1
    sink.mark_published(spark, folder, run, "2025-01-03")
    assert alerts().first()["is_published_to_kafka"]
    store(run, 10, 0, "2025-02-01")
    assert audit()[run]["status"] == "success" and audit()[run]["id"] == 1 and str(audit()[run]["created_at"]).startswith("2025-01-01")
    assert audit()["other"]["id"] == 2 and len(audit()) == 2
    assert alerts().count() == 0, "a run without alerts still replaces its old ones"
    checks = tables.read(spark, folder, "pipeline_quality_checks")
    assert checks.count() == 4 and checks.select("id").distinct().count() == 4
    quality.assert_written(tables.read(spark, folder, "pipeline_run_audit"), checks, run)
    with pytest.raises(RuntimeError):
        quality.assert_written(tables.read(spark, folder, "pipeline_run_audit"), checks, "unknown")


def raw_topic(spark, folder, batches=3):
    """The message table as a raw topic written in several batches."""
    sent = bridge.messages(spark, SF).withColumn("position", F.col("row_id"))
    for n in range(batches):
        topics.publish(sent.filter(F.col("row_id") % batches == n), f"{folder}/raw", topics.RAW_TOPIC, n)
    return f"{folder}/raw"


def load_all(spark, folder, raw, per_trigger):
    at = jobs.run_folders(folder, f"by-{per_trigger}")
    seen, loaded = jobs.Counters(), jobs.Counters()
    outgoing = [validate.PROCESSED_TOPIC, validate.INVALID_TOPIC]
    stages = [
        lambda: jobs.start_validator(topics.stream(spark, raw, [topics.RAW_TOPIC], per_trigger), at["topics"], at["validator_checkpoint"], counters=seen, now=NOW),
        lambda: jobs.start_loader(topics.stream(spark, at["topics"], outgoing, per_trigger), at["tables"], at["loader_checkpoint"], counters=loaded, now=NOW),
    ]
    jobs.run_sequential(stages)
    return at, seen, loaded, stages


def test_stream_equals_batch_for_one_and_many_batches(spark, folder):
    raw = raw_topic(spark, folder)
    expected = mapping.processed_rows(
        mapping.map_processed(validate.routed(topics.read(spark, raw, [topics.RAW_TOPIC]), NOW).filter(F.col("topic") == validate.PROCESSED_TOPIC)), F.col("position"), NOW
    )
    for per_trigger in (512, 2):
        at, seen, loaded, stages = load_all(spark, folder, raw, per_trigger)
        rows = tables.read_loaded(spark, at["tables"], "processed_iot_logs")
        assert rows.drop("id").exceptAll(expected.drop("id")).isEmpty() and expected.drop("id").exceptAll(rows.drop("id")).isEmpty()
        assert rows.select("id").distinct().count() == rows.count() and dict(rows.dtypes)["id"] == "bigint"
        assert seen.totals == {"consumed": 1000, "processed": rows.count(), "invalid": 1000 - rows.count()}
        assert loaded.totals["invalid"] == tables.read_loaded(spark, at["tables"], "invalid_iot_logs").count()
        before = rows.count()
        jobs.run_sequential(stages)
        assert tables.read_loaded(spark, at["tables"], "processed_iot_logs").count() == before, "a rerun adds nothing"
    assert tables.newest_batch(spark, at["tables"]) > 0


def test_replayed_unfinished_and_bad_batches(spark, folder):
    good = json.dumps({c: "x" for c in csv.COLUMNS} | {"event_timestamp": NOW, "processed_at": NOW, "packet_size": 1, "duration_ms": 1})
    bad = json.dumps({"raw_payload": " x ", "error_reason": "why", "failed_at": NOW})
    rows = [
        (1, None, good, validate.PROCESSED_TOPIC), (2, None, "{", validate.PROCESSED_TOPIC), (3, None, good, "stray"), (4, None, bad, validate.INVALID_TOPIC),
        (5, None, good, validate.INVALID_TOPIC), (6, None, None, validate.INVALID_TOPIC), (7, None, good, None),
    ]
    batch = spark.createDataFrame(rows, "position bigint, key string, value string, topic string")
    counters = jobs.Counters()
    for _ in range(2):
        jobs.load_batch(batch, folder, 0, counters, NOW)
    assert tables.read_loaded(spark, folder, "processed_iot_logs").count() == 1
    invalid = tables.read_loaded(spark, folder, "invalid_iot_logs").first()
    assert (invalid["raw_payload"], invalid["error_reason"]) == ("x", "why")
    reasons = sorted(r["reason"] for r in tables.read_loaded(spark, folder, "load_quarantine").collect())
    assert reasons == [
        "invalid JSON: malformed document", "invalid JSON: malformed document", "missing required field: raw_payload",
        "received message from unexpected topic null", "received message from unexpected topic stray",
    ]
    assert counters.totals == {"processed": 1, "invalid": 1, "failed": 5}, "a repeated batch is counted once"
    # the next batch goes on with the ids, whatever was tried in between
    with pytest.raises(Exception, match="halfway"):
        broken = F.when(F.col("position") == 7, F.raise_error(F.lit("halfway")).cast("string")).otherwise(F.col("value"))
        jobs.load_batch(batch.withColumn("value", broken), folder, 1, counters, NOW)
    assert tables.newest_batch(spark, folder) == 0 and tables.read_loaded(spark, folder, "processed_iot_logs").count() == 1
    jobs.load_batch(batch, folder, 1, counters, NOW)
    for name in ("processed_iot_logs", "invalid_iot_logs", "load_quarantine"):
        ids = [r["id"] for r in tables.read(spark, folder, name).collect()]
        assert len(ids) == len(set(ids)) and min(ids) >= 1
    before = {r["id"] for r in tables.read(spark, folder, "processed_iot_logs").collect()}
    jobs.load_batch(batch, folder, 0, counters, NOW)
    assert {r["id"] for r in tables.read(spark, folder, "processed_iot_logs").collect()} == before
    sink.truncate(spark, folder)
    assert tables.read_loaded(spark, folder, "processed_iot_logs").count() == 0 and tables.newest_batch(spark, folder) == -1
    jobs.load_batch(batch, folder, 0, counters, NOW)
    assert max(r["id"] for r in tables.read(spark, folder, "processed_iot_logs").collect()) <= 7, "ids start again"


def test_run_tables_survive_a_crash(spark, folder):
    def rows(run, *kinds):
        return spark.createDataFrame([(i, k, "w", "m", "s", False, run) for i, k in enumerate(kinds)], (
            "id bigint, alert_type string, alert_level string, alert_message string, source string, is_published_to_kafka boolean, run_id string"
        )).withColumn("created_at", F.lit(NOW).cast("timestamp"))

    def kinds(run="r/1 =%"):
        return sorted(r["alert_type"] for r in tables.read(spark, folder, "pipeline_alerts").filter(F.col("run_id") == run).collect())

    run = "r/1 =%"
    assert tables.read(spark, folder, "pipeline_alerts").isEmpty()
    sink.append_run(rows(run, "a", "b").unionByName(rows("other", "o")), folder, "pipeline_alerts")
    sink.append_run(rows(run, "c"), folder, "pipeline_alerts")
    assert kinds() == ["a", "b", "c"]
    sink.mark_published(spark, folder, run, NOW)
    assert tables.read(spark, folder, "pipeline_alerts").filter("is_published_to_kafka").count() == 3
    with pytest.raises(Exception, match="halfway"):
        sink.replace_run(rows(run, "x").withColumn("source", F.raise_error(F.lit("halfway")).cast("string")), folder, "pipeline_alerts", run)
    assert kinds() == ["a", "b", "c"] and tables.read(spark, folder, "pipeline_alerts").filter("is_published_to_kafka").count() == 3
    sink.replace_alerts(rows(run, "x"), folder, run)
    assert kinds() == ["x"] and tables.read(spark, folder, "pipeline_alerts").filter("is_published_to_kafka").isEmpty()
    sink.replace_alerts(rows(run), folder, run)
    assert kinds() == [] and kinds("other") == ["o"]
    sink.append_run(rows(run, "y"), folder, "pipeline_alerts")
    sink.append_run(rows(run), folder, "pipeline_alerts")
    assert kinds() == ["y"]


def test_bounded_messages(spark):
    df = spark.range(100).withColumnRenamed("id", "position")
    assert jobs.bounded(df, 7).agg(F.max("position")).first()[0] == 6 and jobs.bounded(df, 0).count() == 100


def test_concurrent_run_and_failure(spark, folder):
    at = jobs.run_folders(folder, "live")
    spark.createDataFrame([], "position bigint, key string, value string").write.parquet(f"{at['raw_topic']}/batch_id=99/topic=none")
    spark.createDataFrame([], "position bigint, key string, value string").write.parquet(f"{at['topics']}/batch_id=99999/topic=none")
    sent = bridge.messages(spark, SF).limit(50)
    outgoing = [validate.PROCESSED_TOPIC, validate.INVALID_TOPIC]
    loaded = jobs.Counters()
    jobs.run_concurrent(
        [
            lambda: jobs.start_validator(topics.stream(spark, at["raw_topic"], [topics.RAW_TOPIC]), at["topics"], at["validator_checkpoint"], every="1 second"),
            lambda: jobs.start_loader(topics.stream(spark, at["topics"], outgoing), at["tables"], at["loader_checkpoint"], every="1 second", counters=loaded),
        ],
        producer=lambda: topics.publish(sent, at["raw_topic"], topics.RAW_TOPIC),
        idle_seconds=8,
    )
    assert loaded.totals["processed"] + loaded.totals["invalid"] == 50
    assert not spark.streams.active

    def fail():
        raise RuntimeError("producer failed")

    with pytest.raises(RuntimeError, match="producer failed"):
        jobs.run_concurrent([lambda: jobs.start_validator(topics.stream(spark, at["raw_topic"], [topics.RAW_TOPIC]), at["topics"], at["validator_checkpoint"], every="1 second")], fail, 5)
    assert not spark.streams.active


def test_counters_of_a_replayed_stream(spark, folder):
    """A checkpoint that lost its last commit repeats the batch; the counts stay those of the messages."""
    raw, seen = raw_topic(spark, folder, 1), jobs.Counters()
    start = lambda: jobs.start_validator(topics.stream(spark, raw, [topics.RAW_TOPIC]), f"{folder}/out", f"{folder}/checkpoint", counters=seen, now=NOW)
    start().awaitTermination()
    assert seen.totals["consumed"] == 1000 == seen.totals["processed"] + seen.totals["invalid"]
    for name in ("0", ".0.crc"):
        os.remove(f"{folder}/checkpoint/commits/{name}")
    start().awaitTermination()
    assert seen.totals["consumed"] == 1000 == seen.totals["processed"] + seen.totals["invalid"]
    assert topics.read(spark, f"{folder}/out", [validate.PROCESSED_TOPIC, validate.INVALID_TOPIC]).count() == 1000


def test_bounded_reads_go_on_after_gaps(spark, folder):
    rows = [("t", p, o) for p in range(3) for o in range(0, 20, 1 + p)] + [("u", 0, 7)]
    df = spark.createDataFrame(rows, "topic string, partition bigint, offset bigint")
    got = []
    for bound in (5, 30, 1, 0, 0):
        taken, after = topics.read_range(df, topics.committed_offsets(spark, folder, "g"), bound)
        part = [tuple(r) for r in taken.collect()]
        assert not bound or len(part) <= bound
        got += part
        topics.commit_offsets(after, folder, "g")
    assert sorted(got) == sorted(rows)
    assert topics.committed_offsets(spark, folder, "other").isEmpty()


def test_refused_messages_are_counted(spark, folder):
    sent = spark.createDataFrame([("k", "x" * n) for n in (1, 50, 500)] + [("k", None)], "key string, value string")
    assert tuple(topics.publish(sent, folder, "t", max_bytes=100).first()) == (2, 2)
    assert tuple(topics.publish(sent.limit(0), folder, "t", 1).first()) == (0, 0)


def test_headers_of_many_files(spark, folder):
    os.makedirs(f"{folder}/many")
    turned = [*csv.COLUMNS[3:], *csv.COLUMNS[:3]]
    for n in range(120):
        head = ",".join(turned) if n % 40 == 7 else HEADER
        write(f"{folder}/many/{n:03}.csv", *[line(device=f"d{n}")] * 3, head=("\n\ufeff" if n == 5 else "") + head)
    sizes = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = csv.headers(spark, f"{folder}/many")
    assert sorted(map(len, found.values())) == [3, 117] and set(found) == {csv.COLUMNS, tuple(turned)}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == sizes
    for n in range(7, 120, 40):
        os.remove(f"{folder}/many/{n:03}.csv")
    assert csv.headers(spark, f"{folder}/many") == {csv.COLUMNS: [f"{folder}/many"]}


def test_contract_errors_of_files_and_splits(spark, folder):
    os.makedirs(f"{folder}/in")
    for name in "ab":
        write(f"{folder}/in/{name}.csv", *[line(device=f"device-{i:06}", size="-1" if i % 100 == 0 else "7") for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        scanned = csv.scan_places(spark, f"{folder}/in")
        assert scanned.select("_file", "_block").distinct().count() > 8
        for splits in (65_536, 3):  # the second way is that of very many splits
            ordering.SPLITS = splits
            summary, errors = contract.run_on_files(scanned, contract.RAW_LOG_CONTRACT)
            assert tuple(summary.first())[:4] == (6000, 5940, 60, 60)
            got = sorted((r["file"][-5:], r["row_number"], r["error"]) for r in errors.collect())
            assert got == [(f"{f}.csv", i + 2, f"Row {i + 2}: column 'packet_size' must be >= 0, got -1.") for f in "ab" for i in range(0, 3000, 100)]
            plan = errors._jdf.queryExecution().executedPlan().toString()
            assert splits == 3 or "Exchange hashpartitioning" not in plan, "rows with errors meet the splits without a shuffle"
        rows = csv.scan_text(spark, f"{folder}/in").select("device_id", "row_number").collect()
        assert all(int(r["device_id"].strip()[-6:]) + 2 == r["row_number"] for r in rows) and len(rows) == 6000
    finally:
        ordering.SPLITS = 65_536
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_latest_run_reads_one_partition(spark, folder):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS ember_runs LOCATION '{folder}/runs'")
    try:
        for name in ("iot_anomalies", "pipeline_run_audit"):
            sink.create_if_missing(spark, f"ember_runs.{name}", name)
        days = bridge.stored_anomalies(spark, SF)
        audit = bridge.run_audit(spark, SF).withColumn("run_id", F.replace("run_id", F.lit("run-"), F.lit("anomaly-")))
        sink.insert(days, "ember_runs.iot_anomalies", "iot_anomalies", f"{folder}/drafts")
        sink.insert(audit, "ember_runs.pipeline_run_audit", "pipeline_run_audit", f"{folder}/drafts")
        got = runs.rows_of_latest(spark.table("ember_runs.iot_anomalies"), spark.table("ember_runs.pipeline_run_audit"))
        newest = audit.agg(F.max("run_id")).first()[0]
        assert {r["run_id"] for r in got.collect()} == {newest}
        assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
        ids = [r["id"] for r in spark.table("ember_runs.iot_anomalies").select("id").collect()]
        assert len(set(ids)) == len(ids) == days.count() and min(ids) == 1
    finally:
        spark.sql("DROP DATABASE ember_runs CASCADE")


def test_full_run_stops_at_the_contract(spark, folder):
    with pytest.raises(contract.ContractError):
        full_run.run(spark, bridge.logs(spark, SF), folder, "r", NOW, row_number=F.col("row_id") + 1)
    assert not tables.exists(spark, f"{folder}/r/raw_topic")


def test_row_numbers_start_per_file(spark, folder):
    for name in ("a", "b"):
        write(f"{folder}/{name}.csv", line(), line())
    rows = csv.scan_text(spark, folder)
    assert sorted(r["row_number"] for r in rows.collect()) == [2, 2, 3, 3]
