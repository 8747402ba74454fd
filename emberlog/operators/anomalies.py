"""Five rules over processed rows, all evaluated in one pass, and the roll-ups of their output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import iso_millis
from ..functions.ordering import newest_first, top_rows
from ..functions.text import quote, quote_list, strip

# Fixed values of the rules.
EXPECTED_PROTOCOLS = ("ICMP", "TCP", "UDP")
QUIET_PROTOCOLS = ("ICMP",)
BENIGN_LABELS = ("", "benign", "none", "normal", "unknown", "n/a", "na")
HIGH_RISK_LABELS = (
    "arp_poisoning", "arp_poisioning", "botnet", "brute_force", "ddos", "dos",
    "malware", "mitm", "port_scan", "ransomware", "sql_injection",
)
DENIED_STATUSES = ("blocked", "denied", "dropped")
FAILED_STATUSES = ("failed", "error")


@dataclass(frozen=True)
class Rules:
    """Thresholds and word lists; pass another instance to change a rule."""

    packet_high: int = 1500
    packet_review: int = 1000
    duration_high: int = 15000
    duration_review: int = 5000
    expected_protocols: tuple[str, ...] = EXPECTED_PROTOCOLS
    quiet_protocols: tuple[str, ...] = QUIET_PROTOCOLS
    benign_labels: tuple[str, ...] = BENIGN_LABELS
    high_risk_labels: tuple[str, ...] = HIGH_RISK_LABELS
    denied_statuses: tuple[str, ...] = DENIED_STATUSES
    failed_statuses: tuple[str, ...] = FAILED_STATUSES


def recent(rows: DataFrame, limit: int | None) -> DataFrame:
    """The newest rows by processing, insert or event time; all rows without a limit."""
    if limit is None:
        return rows
    if limit <= 0:
        raise ValueError("limit must be a positive integer")
    moment = F.coalesce("processed_at", "inserted_at", "event_timestamp")
    return top_rows(rows, newest_first(moment, F.col("id")), limit)


def rule_input(rows: DataFrame) -> DataFrame:
    """Shape the rules read: text never NULL, upper protocol, lower status, UTC millisecond time."""
    text = {n: strip(f"coalesce({n}, '')") for n in ("device_id", "protocol", "attack_type", "status")}
    return rows.selectExpr(
        "id AS source_row_id",
        f"{text['device_id']} AS device_id",
        f"coalesce({iso_millis('event_timestamp')}, '') AS event_timestamp",
        f"upper({text['protocol']}) AS protocol",
        "packet_size",
        "duration_ms",
        f"{text['attack_type']} AS attack_type",
        f"lower({text['status']}) AS status",
    )


def _finding(rule: str, severity: str, score: int, column: str, reason: str) -> str:
    """SQL of one finding; its reason starts with ``column=value``."""
    return (
        f"named_struct('rule_name', '{rule}', 'severity', '{severity}', "
        f"'reason', concat('{column}=', {column}, {quote(' ' + reason)}), 'score', {score})"
    )


def findings(rules: Rules = Rules()) -> list[str]:
    """SQL of one nullable struct per rule, in report order."""
    label = f"lower({strip('attack_type')})"
    status_rule, label_rule, protocol_rule = "failed_or_blocked_status", "suspicious_attack_type", "unusual_protocol"
    expected = "[" + ", ".join(repr(p) for p in sorted(rules.expected_protocols)) + "]"
    limits = (
        ("high_packet_size", "packet_size", "bytes", (rules.packet_high, 90), (rules.packet_review, 70)),
        ("high_duration", "duration_ms", "ms", (rules.duration_high, 85), (rules.duration_review, 65)),
    )
    cases: list[list[tuple[str, str]]] = [
        [
            (f"{column} >= {high}", _finding(rule, "high", high_score, column, f"exceeds the high threshold of {high} {unit}.")),
            (f"{column} >= {review}", _finding(rule, "medium", review_score, column, f"exceeds the review threshold of {review} {unit}.")),
        ]
        for rule, column, unit, (high, high_score), (review, review_score) in limits
    ]
    cases += [
        [
            (f"status IN ({quote_list(rules.denied_statuses)})",
             _finding(status_rule, "high", 95, "status", "indicates traffic that was blocked or denied.")),
            (f"status IN ({quote_list(rules.failed_statuses)})",
             _finding(status_rule, "medium", 75, "status", "indicates unsuccessful processing or failed traffic.")),
        ],
        [
            (f"{label} IN ({quote_list(rules.high_risk_labels)})",
             _finding(label_rule, "high", 92, "attack_type", "matches a high-risk suspicious traffic label.")),
            (f"{label} NOT IN ({quote_list(('', *rules.benign_labels))})",
             _finding(label_rule, "medium", 68, "attack_type", "is non-empty and marked for analyst review.")),
        ],
        [
            (f"protocol NOT IN ({quote_list(('', *rules.expected_protocols))})",
             _finding(protocol_rule, "high", 80, "protocol", f"is outside the expected set {expected}.")),
            (f"protocol IN ({quote_list(rules.quiet_protocols)})",
             _finding(protocol_rule, "low", 35, "protocol", "is allowed but treated as less common control-plane traffic.")),
        ],
    ]
    return ["CASE " + " ".join(f"WHEN {test} THEN {found}" for test, found in rule) + " END" for rule in cases]


def _found(rules: Rules) -> str:
    return f"array_compact(array({', '.join(findings(rules))}))"


def detect(rows: DataFrame, limit: int | None = None, rules: Rules = Rules()) -> DataFrame:
    """Zero to five findings per row."""
    shaped = rule_input(recent(rows, limit))
    return shaped.selectExpr("source_row_id", "device_id", "event_timestamp", f"inline({_found(rules)})")


def store_form(found: DataFrame, run_id: Column | str, created_at: Column | str) -> DataFrame:
    """Rows of the anomaly table: empty text becomes NULL, the row reference becomes text."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    stamp = created_at if isinstance(created_at, Column) else F.lit(created_at).cast("timestamp")
    return found.select(
        run.alias("run_id"),
        F.col("source_row_id").cast("string").alias("source_row_id"),
        F.nullif("event_timestamp", F.lit("")).cast("timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        F.nullif("device_id", F.lit("")).alias("device_id"),
        "rule_name", "severity", "reason",
        F.col("score").cast("decimal(38,18)").alias("score"),
        stamp.cast("timestamp_ntz").alias("created_at"),
    )


def by_rule(found: DataFrame, ordered: bool = False) -> DataFrame:
    """Findings per rule; ``ordered`` sorts by rule, as reports list them."""
    return _counted(found, "rule_name", ordered)


def by_severity(found: DataFrame, ordered: bool = False) -> DataFrame:
    return _counted(found, "severity", ordered)


def _counted(found: DataFrame, key: str, ordered: bool) -> DataFrame:
    counts = found.groupBy(key).agg(F.count(F.lit(1)).alias("anomalies"))
    return counts.orderBy(key) if ordered else counts


def affected_rows(found: DataFrame) -> DataFrame:
    return found.agg(F.count_distinct("source_row_id").alias("rows_with_anomalies"))


def summary(rows: DataFrame, limit: int | None = None, rules: Rules = Rules()) -> DataFrame:
    """One row: rows scanned, findings, affected rows, and counts per rule and severity.

    Counted from the findings array of each row, so neither an explode nor a distinct count is
    needed: a source row is affected when its array is not empty (row ids are unique).
    """
    names = ("failed_or_blocked_status", "high_duration", "high_packet_size", "suspicious_attack_type", "unusual_protocol")
    levels = ("high", "low", "medium")
    shaped = rule_input(recent(rows, limit)).selectExpr("source_row_id", f"{_found(rules)} AS found")

    def hits(field: str, value: str) -> Column:
        return F.sum(F.size(F.filter("found", lambda f: f[field] == value))).alias(f"{field}_{value}")

    counted = shaped.agg(
        F.count(F.lit(1)).alias("rows_scanned"),
        F.coalesce(F.sum(F.size("found")), F.lit(0)).alias("anomalies_detected"),
        F.count_if((F.size("found") > 0) & F.col("source_row_id").isNotNull()).alias("rows_with_anomalies"),
        *[hits("rule_name", n) for n in names],
        *[hits("severity", s) for s in levels],
    )

    def counts(field: str, values) -> Column:
        pairs = [F.struct(F.lit(v).alias("k"), F.col(f"{field}_{v}").alias("v")) for v in values]
        return F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"] > 0))

    return counted.select(
        "rows_scanned", "anomalies_detected", "rows_with_anomalies",
        counts("rule_name", names).alias("anomalies_by_rule"),
        counts("severity", levels).alias("anomalies_by_severity"),
    )


def rule_by_severity(found: DataFrame, *keys: str, ordered: bool = False) -> DataFrame:
    """Rule and severity counts; extra leading keys (a run id) are optional. ``ordered``: most findings first."""
    counts = found.groupBy(*keys, "rule_name", "severity").agg(F.count(F.lit(1)).alias("anomaly_rows"))
    return counts.orderBy(F.col("anomaly_rows").desc(), "rule_name", "severity") if ordered else counts


def per_run(stored: DataFrame, newest: int = 5) -> DataFrame:
    counted = stored.groupBy("run_id").agg(F.count(F.lit(1)).alias("anomaly_rows"))
    return counted.orderBy(F.col("run_id").desc()).limit(newest)


def latest_run(stored: DataFrame) -> DataFrame:
    """One row with the run id of the newest finding, as an aggregate with one partial row per task."""
    return stored.agg(F.max(F.struct("created_at", "run_id"))["run_id"].alias("run_id"))


def latest_run_rollup(stored: DataFrame, ordered: bool = False) -> DataFrame:
    # the joined side is a global aggregate: exactly one row
    return rule_by_severity(stored.join(F.broadcast(latest_run(stored)), "run_id"), "run_id", ordered=ordered)
