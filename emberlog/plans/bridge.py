"""Log inputs derived from the provided tables (the tables themselves hold no device logs)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import quote_list
from ..operators import anomalies, mapping, perf, quality, staging, validate
from ..session import prepare, scratch_dir

AS_OF = "2025-06-01T00:00:00Z"
# a threshold that some daily runs pass and some break
RUN_SETTINGS = quality.RunSettings(invalid_rate_threshold=Decimal("0.08"))
ARP_LABEL = "ARP_poisioning"
ATTACK_LABELS = ["DDoS", ARP_LABEL, "DOS_SYN_Hping", "port_scan", "", "unknown"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# derived columns, over k (0 to 99, from the props text), user_id, event_type and value
LOG_COLUMNS = {
    "event_timestamp": "CASE WHEN k = 15 THEN 'not-a-timestamp' "
    "ELSE date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") END",
    "device_id": "concat(' device_', lpad(cast(user_id AS string), 6, '0'), ' ')",
    "source_ip": "concat('10.0.', user_id % 256, '.', k)",
    "destination_ip": "concat('192.168.', k % 16, '.', user_id % 256)",
    "protocol": "CASE WHEN k IN (18, 19) THEN 'http' WHEN k % 10 < 5 THEN 'tcp' WHEN k % 10 < 8 THEN ' UDP ' ELSE 'icmp' END",
    "packet_size": "CASE k WHEN 13 THEN '-1' WHEN 14 THEN 'abc' ELSE cast(floor(value * 10) AS string) END",
    "duration_ms": "cast(k * 200 AS string)",
    "event_type": "CASE WHEN k = 21 THEN 'reboot' "
    "WHEN event_type = 'purchase' OR (user_id % 10 = 0 AND event_type <> 'view') THEN 'Attack' "
    "WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'warning' ELSE 'normal' END",
    "attack_type": f"CASE WHEN event_type = 'purchase' THEN element_at(array({quote_list(ATTACK_LABELS)}), k % 6 + 1) ELSE '' END",
    "status": "CASE WHEN k = 16 THEN '' WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 'failed' ELSE 'Error' END "
    "WHEN event_type = 'purchase' AND k % 3 = 0 THEN 'blocked' ELSE 'success' END",
}


def raw_logs(events: DataFrame) -> DataFrame:
    """Ten text columns in raw-file form plus ``row_id``, ``k`` and ``day``."""
    keyed = events.selectExpr(
        "event_id + 1 AS row_id", "from_json(props, 'k int').k AS k", "ts", "user_id", "event_type", "value"
    )
    return keyed.selectExpr(
        "row_id", "k", "date_format(ts, 'yyyy-MM-dd') AS day", *[f"{sql} AS {name}" for name, sql in LOG_COLUMNS.items()]
    )


def raw_messages(raw: DataFrame) -> DataFrame:
    """JSON message per raw row: ``row_id``, ``day``, ``key`` (device), ``value``."""
    quoted = {name: f"concat('\"{name}\":\"', {name}, '\"')" for name in LOG_COLUMNS}
    bare = {name: f"concat('\"{name}\":', {name})" for name in ("packet_size", "duration_ms")}
    parts = {
        **quoted,
        "packet_size": f"CASE WHEN k = 14 THEN {quoted['packet_size']} ELSE {bare['packet_size']} END",
        "duration_ms": bare["duration_ms"],
        "status": f"CASE WHEN k <> 16 THEN {quoted['status']} END",
        # some messages carry the optional time, some a field the schema does not name, with escapes
        "ingestion_timestamp": "CASE WHEN k % 3 = 0 THEN concat('\"ingestion_timestamp\":\"', day, 'T23:59:58Z\"') END",
        "note": "CASE WHEN k % 4 = 1 THEN concat('\"note\":\"a\\\\\"b\\\\u00e9 ', k, '\"') END",
    }
    return raw.selectExpr(
        "row_id", "day", "device_id AS key",
        "CASE WHEN k = 17 THEN '{\"event_timestamp\": ' "
        f"ELSE concat('{{', concat_ws(',', {', '.join(parts.values())}), '}}') END AS value",
    )


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_logs(table(spark, sf_dir, "events"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_messages(logs(spark, sf_dir))


def dealt_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``messages`` dealt evenly over several tasks a core before they are built.

    A few bytes of an event make a message that takes long to parse, so the splits of a small compact file are too few.
    """
    events = table(spark, sf_dir, "events")
    return raw_messages(raw_logs(events.repartition(4 * spark.sparkContext.defaultParallelism, *events.columns)))


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.check(messages(spark, sf_dir))


def kept_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``checked``, stored once for jobs that read it several times: no message is parsed again.

    Only rejected messages keep their ``raw_text``; ``value`` and ``key`` are left out.
    """
    text = F.when(F.col("error_reason").isNotNull(), F.col("raw_text"))
    checks = validate.check(dealt_messages(spark, sf_dir))
    frame, folder = checks.drop("value", "key").withColumn("raw_text", text), scratch_dir(spark, "checked")
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.normalized(checked(spark, sf_dir), AS_OF)


def processed(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> DataFrame:
    """Rows of the processed table; ``messages``: checked ones that are stored already (so in the functions below)."""
    good = valid(spark, sf_dir) if messages is None else validate.normalized(messages, AS_OF)
    return mapping.rows_from_valid(good, F.col("row_id"), AS_OF)


def invalid(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> DataFrame:
    return validate.rejected(checked(spark, sf_dir) if messages is None else messages, AS_OF).select(
        F.col("row_id").alias("id"), "raw_payload", "error_reason", "failed_at", F.lit(AS_OF).cast("timestamp").alias("inserted_at")
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of each message and when: one parse for valid and rejected ones."""
    return validate.outcomes(checked(spark, sf_dir), AS_OF)


def staged(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> DataFrame:
    return staging.stage_processed(processed(spark, sf_dir, messages))


def staged_invalid(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> DataFrame:
    return staging.stage_invalid(invalid(spark, sf_dir, messages))


def run_metrics(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> DataFrame:
    """One quality run per day of the log."""
    outcome = (checked(spark, sf_dir) if messages is None else messages).select("day", F.col("error_reason").isNull().alias("ok"))
    return quality.metrics_by_run(outcome, F.concat(F.lit("run-"), "day"), F.col("ok"))


def day_of(run_id: Column) -> Column:
    return F.substring(run_id, 5, 10).cast("timestamp")


def run_audit(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> DataFrame:
    """Stored audit rows of the daily runs."""
    day = day_of(F.col("run_id"))
    rows = quality.audit_rows(run_metrics(spark, sf_dir, messages), day, day + F.expr("interval 1 hour"), RUN_SETTINGS)
    return rows.select(
        run_number(F.col("run_id")).alias("id"), "*", (day + F.expr("interval 2 hours")).alias("created_at")
    )


def run_number(run_id: Column) -> Column:
    """A unique number per daily run: its day as yyyymmdd."""
    return F.replace(F.substring(run_id, 5, 10), F.lit("-"), F.lit("")).cast("bigint")


def run_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored check rows of the daily runs."""
    rows = quality.quality_checks(run_metrics(spark, sf_dir), RUN_SETTINGS)
    second = F.when(F.col("check_name") == "invalid_rate_threshold", 1).otherwise(0)
    return rows.select(
        (run_number(F.col("run_id")) * 2 + second).alias("id"), "*",
        (day_of(F.col("run_id")) + F.expr("interval 2 hours")).alias("created_at"),
    )


def run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored alert rows of the daily runs."""
    rows = quality.quality_checks(run_metrics(spark, sf_dir), RUN_SETTINGS)
    raised = quality.alerts(rows, day_of(F.col("run_id")) + F.expr("interval 2 hours"), RUN_SETTINGS)
    return raised.select(run_number(F.col("run_id")).alias("id"), "*")


def stored_anomalies(spark: SparkSession, sf_dir: str, messages: DataFrame | None = None) -> DataFrame:
    """Anomaly table with one run per day of the events."""
    found = anomalies.detect(processed(spark, sf_dir, messages))
    day = F.substring("event_timestamp", 1, 10)
    return anomalies.store_form(found, F.concat(F.lit("anomaly-"), day), day.cast("timestamp"))


def timed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark runs: one per order line, with whole-second step times so that sums are exact."""
    line = table(spark, sf_dir, "lineitem")
    number = lambda c: c.cast("bigint").cast("double")
    steps = {
        "go-producer": number(F.col("l_quantity")),
        "python-consumer": number(F.round(F.col("l_discount") * 100) * 3),
        "warehouse-loader": number(F.round(F.col("l_tax") * 100) * 4),
        "anomaly-detection": number(F.col("l_linenumber")),
    }
    commands = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"), F.array(F.lit("run"), F.lit(name)).alias("command"),
                seconds.alias("elapsed_seconds"), F.lit(0).cast("bigint").alias("return_code"),
            )
            for name, seconds in steps.items()
        ]
    )
    part = lambda n: F.element_at(F.array(*[F.lit(p) for p in perf.PROFILES]), (F.col(n) % 3 + 1).cast("int"))
    sized = line.select(
        F.concat_ws("-", F.lit("run"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("file"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        part("l_partkey").alias("profile"),
        ((F.col("l_suppkey") % 4 + 1) * 1000).cast("bigint").alias("rows"),
        ((F.col("l_suppkey") % 2 + 1) * 1000).cast("bigint").alias("consumer_messages"),
        F.lit(5000).cast("bigint").alias("loader_messages"),
        (F.col("l_returnflag") == "R").alias("dry_run"),
        commands.alias("commands"),
    )
    return sized.withColumn("total_elapsed_seconds", perf.total_seconds())


def object_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object-store events from page addresses: host as bucket, path as key, both event shapes."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    host = F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1)
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+/?(.*)$", 1)
    layer = F.element_at(F.array(*[F.lit(x) for x in ("raw/", "Processed/", "misc/", "", "a/curated/")]), (F.col("page_id") % 5 + 1).cast("int"))
    ending = F.element_at(F.array(*[F.lit(x) for x in (".csv", ".PARQUET", ".jsonl", ".txt", "", ".json", "/")]), (F.col("page_id") % 7 + 1).cast("int"))
    key = F.when(F.col("page_id") % 11 == 0, "").otherwise(F.concat(layer, F.replace(path, F.lit("?"), F.lit("+")), ending))
    s3 = F.concat(
        F.lit('{"Records":[{"eventName":"put","s3":{"bucket":{"name":"'), host, F.lit('"},"object":{"key":"'), key, F.lit('"}}},{}]}')
    )
    flat = F.concat(F.lit('{"s3_bucket":"'), host, F.lit('","object_key":"'), key, F.lit('"}'))
    event = F.when(F.col("page_id") % 13 == 0, F.lit("[]")).when(F.col("page_id") % 2 == 0, s3).otherwise(flat)
    return pages.select("page_id", event.alias("event"))


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message table as a stream; the row id is the position."""
    schema = table(spark, sf_dir, "events").schema
    # a pattern, because a stream source takes a folder or a pattern but not one file
    source = spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet")
    return raw_messages(raw_logs(source)).select(F.col("row_id").alias("position"), "key", "value", F.lit("iot_raw_logs").alias("topic"))


# faults put into the run documents, by line number; the others stay whole
DOCUMENT_FAULTS = {
    2: ("timestamp", "null"), 3: ("profile", '"tiny"'), 4: ("rows", "true"), 5: ("commands", "[]"),
    6: ("commands", '[{"name":"x","command":[1],"elapsed_seconds":1}]'), 7: ("total_elapsed_seconds", '"1"'),
}


def run_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON document per timed run (``file``, ``content``); the line number decides on a fault."""
    runs = timed_runs(spark, sf_dir).withColumn("line", F.element_at(F.split("file", "-"), 3).cast("int"))
    names = ("timestamp", "profile", "rows", "consumer_messages", "loader_messages", "dry_run", "total_elapsed_seconds", "commands")
    quoted = {"timestamp", "profile"}

    def part(name: str) -> str:
        text = f"to_json({name})" if name == "commands" else f"cast({name} AS string)"
        whole = f"concat('\"', {text}, '\"')" if name in quoted else text
        faults = "".join(f" WHEN line = {n} THEN '{value}'" for n, (field, value) in DOCUMENT_FAULTS.items() if field == name)
        return f"concat('\"{name}\":', {f'CASE{faults} ELSE {whole} END' if faults else whole})"

    return runs.selectExpr("file", f"concat('{{', concat_ws(',', {', '.join(part(n) for n in names)}), '}}') AS content")
