"""Comparison SQL for the registered queries, written for DuckDB from the rules, not from the Spark
code: JSON text is read with DuckDB's own functions and rounding is exact integer arithmetic."""

from __future__ import annotations

# Fixed values, written out here so that a wrong list in the operators does not pass.
COLUMNS = "event_timestamp device_id source_ip destination_ip protocol packet_size duration_ms event_type attack_type status".split()
ATTACK_LABELS = ["DDoS", "ARP_poisioning", "DOS_SYN_Hping", "port_scan", "", "unknown"]
HIGH_RISK_LABELS = "arp_poisoning arp_poisioning botnet brute_force ddos dos malware mitm port_scan ransomware sql_injection".split()
BENIGN_LABELS = ["", "benign", "none", "normal", "unknown", "n/a", "na"]
RULES = ["high_packet_size", "high_duration", "failed_or_blocked_status", "suspicious_attack_type", "unusual_protocol"]
PROFILES = ["sample", "medium", "full"]
LAYERS = ["raw", "processed", "curated", "anomalies"]
EXTENSIONS = [".csv", ".json", ".jsonl", ".parquet"]
MISSING_KEY = "Missing object key in event payload."
BAD_EXTENSION = "Unsupported file extension. Supported extensions: .csv, .json, .jsonl, .parquet."
# contract columns with a list of values, with whole numbers, and the one that may be empty
CONTRACT_LISTS = {
    "protocol": ["TCP", "UDP", "ICMP", "HTTP", "HTTPS", "MQTT", "ARP"], "status": ["success", "failed", "blocked", "allowed", "warning"],
}
CONTRACT_NUMBERS, CONTRACT_OPTIONAL = ("packet_size", "duration_ms"), ("attack_type",)


# an empty CSV field is read back as NULL
COLUMNS_AS_WRITTEN = [f"nullif({c}, '') AS {c}" for c in COLUMNS]


def quote_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


AS_OF = "TIMESTAMP '2025-06-01 00:00:00'"
AS_OF_TEXT = "2025-06-01T00:00:00Z"


def ratio(numerator: str, denominator: str, places: int) -> str:
    """Whole-number ratio rounded half up; NULL for a zero denominator."""
    n, d, scale = f"({numerator})::HUGEINT", f"({denominator})::HUGEINT", 10**places
    return f"CASE WHEN {d} = 0 THEN NULL ELSE ((2 * {scale} * {n} + {d}) // (2 * {d}))::DOUBLE / {scale} END"


def mean(column: str, places: int = 2) -> str:
    return ratio(f"sum({column})", f"count({column})", places)


LABELS = ", ".join(f"'{x}'" for x in ATTACK_LABELS)

RAW = f"""
keyed AS (SELECT *, (props->>'$.k')::INT AS k FROM events),
raw AS (
  SELECT event_id + 1 AS row_id, k, strftime(ts, '%Y-%m-%d') AS day,
    CASE WHEN k = 15 THEN 'not-a-timestamp' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_timestamp,
    ' device_' || lpad(user_id::VARCHAR, 6, '0') || ' ' AS device_id,
    '10.0.' || (user_id % 256) || '.' || k AS source_ip,
    '192.168.' || (k % 16) || '.' || (user_id % 256) AS destination_ip,
    CASE WHEN k IN (18, 19) THEN 'http' WHEN k % 10 < 5 THEN 'tcp' WHEN k % 10 < 8 THEN ' UDP ' ELSE 'icmp' END AS protocol,
    CASE WHEN k = 13 THEN '-1' WHEN k = 14 THEN 'abc' ELSE floor(value * 10)::BIGINT::VARCHAR END AS packet_size,
    (k * 200)::VARCHAR AS duration_ms,
    CASE WHEN k = 21 THEN 'reboot'
         WHEN event_type = 'purchase' OR (user_id % 10 = 0 AND event_type <> 'view') THEN 'Attack'
         WHEN event_type = 'error' THEN 'ERROR' WHEN event_type = 'signup' THEN 'warning' ELSE 'normal' END AS event_type,
    CASE WHEN event_type = 'purchase' THEN ([{LABELS}])[k % 6 + 1] ELSE '' END AS attack_type,
    CASE WHEN k = 16 THEN '' WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 'failed' ELSE 'Error' END
         WHEN event_type = 'purchase' AND k % 3 = 0 THEN 'blocked' ELSE 'success' END AS status
  FROM keyed),
msg AS (
  SELECT row_id, day, device_id AS key,
    CASE WHEN k = 17 THEN '{{"event_timestamp": ' ELSE
      '{{"event_timestamp":"' || event_timestamp || '","device_id":"' || device_id || '","source_ip":"' || source_ip
      || '","destination_ip":"' || destination_ip || '","protocol":"' || protocol || '","packet_size":'
      || CASE WHEN k = 14 THEN '"' || packet_size || '"' ELSE packet_size END
      || ',"duration_ms":' || duration_ms || ',"event_type":"' || event_type || '","attack_type":"' || attack_type || '"'
      || CASE WHEN k = 16 THEN '' ELSE ',"status":"' || status || '"' END
      || CASE WHEN k % 3 = 0 THEN ',"ingestion_timestamp":"' || day || 'T23:59:58Z"' ELSE '' END
      || CASE WHEN k % 4 = 1 THEN ',"note":"a\\"b\\u00e9 ' || k || '"' ELSE '' END || '}}' END AS value
  FROM raw)"""

REQUIRED = ("event_timestamp", "device_id", "source_ip", "destination_ip", "protocol", "packet_size", "duration_ms", "event_type", "status")

_MISSING = ", ".join(
    f"CASE WHEN NOT json_exists(j, '$.{f}') OR (json_type(j, '$.{f}') = 'VARCHAR' AND trim(j->>'$.{f}') = '') THEN 'missing required field: {f}' END"
    for f in REQUIRED
)


def _whole(f: str) -> str:
    return (
        f"CASE WHEN json_type(j, '$.{f}') IN ('UBIGINT', 'BIGINT') OR (json_type(j, '$.{f}') = 'VARCHAR' AND regexp_full_match(trim(j->>'$.{f}'), '[+-]?[0-9]+')) "
        f"THEN try_cast(trim(j->>'$.{f}') AS BIGINT) END"
    )


CHECKED = f"""
doc AS (SELECT row_id, day, value, CASE WHEN json_valid(value) THEN value::JSON END AS j FROM msg),
fields AS (
  SELECT row_id, day, value, j,
    try_strptime(j->>'$.event_timestamp', '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp,
    trim(j->>'$.device_id') AS device_id, trim(j->>'$.source_ip') AS source_ip, trim(j->>'$.destination_ip') AS destination_ip,
    upper(trim(j->>'$.protocol')) AS protocol, {_whole('packet_size')} AS packet_size, {_whole('duration_ms')} AS duration_ms,
    j->>'$.ingestion_timestamp' AS ingestion_text, j->>'$.note' AS note,
    lower(trim(j->>'$.event_type')) AS event_type, j->>'$.attack_type' AS attack_type, lower(trim(j->>'$.status')) AS status,
    concat_ws('; ', {_MISSING}) AS missing
  FROM doc),
checked AS (
  SELECT *, CASE WHEN j IS NULL THEN 'invalid JSON: malformed document'
    WHEN json_type(j) <> 'OBJECT' THEN 'payload must be a JSON object'
    WHEN missing <> '' THEN missing
    ELSE nullif(concat_ws('; ',
      CASE WHEN event_timestamp IS NULL THEN 'invalid timestamp' END,
      CASE WHEN protocol NOT IN ('TCP', 'UDP', 'ICMP') THEN 'invalid protocol' END,
      CASE WHEN packet_size IS NULL OR packet_size < 0 THEN 'packet_size must be a non-negative integer' END,
      CASE WHEN duration_ms IS NULL OR duration_ms < 0 THEN 'duration_ms must be a non-negative integer' END,
      CASE WHEN event_type NOT IN ('normal', 'warning', 'error', 'attack') THEN 'invalid event_type' END), '') END AS error_reason
  FROM fields)"""

TABLES = f"""
good AS (SELECT * FROM checked WHERE error_reason IS NULL),
processed AS (
  SELECT row_id AS id, event_timestamp, device_id, source_ip, destination_ip, protocol, packet_size::INT AS packet_size,
    duration_ms::INT AS duration_ms, event_type, nullif(trim(attack_type), '') AS attack_type, status,
    try_strptime(ingestion_text, '%Y-%m-%dT%H:%M:%SZ') AS ingestion_timestamp, {AS_OF} AS processed_at, {AS_OF} AS inserted_at,
    '{{"attack_type":"' || attack_type || '"' || coalesce(',"ingestion_timestamp":"' || ingestion_text || '"', '')
      || coalesce(',"note":"' || replace(note, '"', '\\"') || '"', '')
      || ',"event_timestamp":"' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%fZ') || '","device_id":"' || device_id || '","source_ip":"' || source_ip
      || '","destination_ip":"' || destination_ip || '","protocol":"' || protocol || '","packet_size":' || packet_size || ',"duration_ms":' || duration_ms
      || ',"event_type":"' || event_type || '","status":"' || status || '","processed_at":"{AS_OF_TEXT}"}}' AS raw_payload FROM good),
invalid AS (
  SELECT row_id AS id, value AS raw_payload, error_reason, {AS_OF} AS failed_at, {AS_OF} AS inserted_at
  FROM checked WHERE error_reason IS NOT NULL),
staged AS (
  SELECT id, event_timestamp, strftime(event_timestamp, '%Y-%m-%d') AS event_date, date_part('hour', event_timestamp)::INT AS event_hour,
    device_id, source_ip, destination_ip, protocol, packet_size, duration_ms, event_type, attack_type, status, ingestion_timestamp, processed_at, inserted_at,
    (event_type = 'attack' OR attack_type IS NOT NULL) AS is_attack, status IN ('failed', 'error') AS is_failed
  FROM processed)"""

_MEANS = f"{mean('packet_size')} AS avg_packet_size, {mean('duration_ms')} AS avg_duration_ms"
_SEEN = "min(event_timestamp) AS first_seen, max(event_timestamp) AS last_seen"
_ATTACKS, _FAILS = "count(*) FILTER (is_attack)", "count(*) FILTER (is_failed)"

MARTS = f"""
rates AS (
  SELECT device_id, count(*) AS total_events, {_ATTACKS} AS attack_events, {_FAILS} AS failed_events,
    count(*) FILTER (event_type = 'normal') AS normal_events, count(*) FILTER (event_type = 'warning') AS warning_events,
    count(*) FILTER (event_type = 'error') AS error_events,
    {ratio(_ATTACKS, 'count(*)', 4)} AS attack_rate, {ratio(_FAILS, 'count(*)', 4)} AS failure_rate, {_MEANS}, {_SEEN}
  FROM staged GROUP BY device_id),
risk AS (
  SELECT *, CASE WHEN attack_rate >= 0.5 OR failure_rate >= 0.5 THEN 'HIGH'
                 WHEN attack_rate >= 0.2 OR failure_rate >= 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM rates),
attacks AS (
  SELECT coalesce(attack_type, 'unknown') AS attack_type, count(*) AS total_attack_events, count(DISTINCT device_id) AS affected_devices,
    {_MEANS}, {_SEEN} FROM staged WHERE is_attack GROUP BY 1),
protocols AS (
  SELECT protocol, count(*) AS total_events, {_ATTACKS} AS attack_events, {_FAILS} AS failed_events,
    {ratio(_ATTACKS, 'count(*)', 4)} AS attack_rate, {_MEANS}, {_SEEN} FROM staged GROUP BY protocol),
quality AS (
  SELECT p.n AS processed_records, i.n AS invalid_records, p.n + i.n AS total_records,
    coalesce({ratio('i.n', 'p.n + i.n', 4)}, 0) AS invalid_rate, p.t AS last_processed_at, i.t AS last_invalid_at
  FROM (SELECT count(*) AS n, max(processed_at) AS t FROM staged) p, (SELECT count(*) AS n, max(failed_at) AS t FROM invalid) i)"""

FOUND = f"""
shaped AS (
  SELECT id AS source_row_id, device_id, strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.') || lpad((date_part('millisecond', event_timestamp)::INT % 1000)::VARCHAR, 3, '0') || 'Z' AS event_timestamp,
    protocol, packet_size, duration_ms, coalesce(attack_type, '') AS attack_type, status FROM processed),
found AS (
  SELECT source_row_id, device_id, event_timestamp, 'high_packet_size' AS rule_name,
    CASE WHEN packet_size >= 1500 THEN 'high' ELSE 'medium' END AS severity,
    'packet_size=' || packet_size || CASE WHEN packet_size >= 1500 THEN ' exceeds the high threshold of 1500 bytes.' ELSE ' exceeds the review threshold of 1000 bytes.' END AS reason,
    CASE WHEN packet_size >= 1500 THEN 90 ELSE 70 END AS score FROM shaped WHERE packet_size >= 1000
  UNION ALL
  SELECT source_row_id, device_id, event_timestamp, 'high_duration', CASE WHEN duration_ms >= 15000 THEN 'high' ELSE 'medium' END,
    'duration_ms=' || duration_ms || CASE WHEN duration_ms >= 15000 THEN ' exceeds the high threshold of 15000 ms.' ELSE ' exceeds the review threshold of 5000 ms.' END,
    CASE WHEN duration_ms >= 15000 THEN 85 ELSE 65 END FROM shaped WHERE duration_ms >= 5000
  UNION ALL
  SELECT source_row_id, device_id, event_timestamp, 'failed_or_blocked_status', 'high',
    'status=' || status || ' indicates traffic that was blocked or denied.', 95 FROM shaped WHERE status IN ('blocked', 'denied', 'dropped')
  UNION ALL
  SELECT source_row_id, device_id, event_timestamp, 'failed_or_blocked_status', 'medium',
    'status=' || status || ' indicates unsuccessful processing or failed traffic.', 75 FROM shaped WHERE status IN ('failed', 'error')
  UNION ALL
  SELECT source_row_id, device_id, event_timestamp, 'suspicious_attack_type', 'high',
    'attack_type=' || attack_type || ' matches a high-risk suspicious traffic label.', 92 FROM shaped
    WHERE lower(attack_type) IN ({quote_list(HIGH_RISK_LABELS)})
  UNION ALL
  SELECT source_row_id, device_id, event_timestamp, 'suspicious_attack_type', 'medium',
    'attack_type=' || attack_type || ' is non-empty and marked for analyst review.', 68 FROM shaped
    WHERE lower(attack_type) NOT IN ({quote_list(HIGH_RISK_LABELS)}) AND lower(attack_type) NOT IN ({quote_list(BENIGN_LABELS)})
  UNION ALL
  SELECT source_row_id, device_id, event_timestamp, 'unusual_protocol', 'low',
    'protocol=ICMP is allowed but treated as less common control-plane traffic.', 35 FROM shaped WHERE protocol = 'ICMP'),
stored AS (
  SELECT 'anomaly-' || event_timestamp[1:10] AS run_id, source_row_id::VARCHAR AS source_row_id,
    strptime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%gZ') AS event_timestamp, device_id, rule_name, severity, reason,
    score::DOUBLE AS score, strptime(event_timestamp[1:10], '%Y-%m-%d') AS created_at FROM found)"""


def _contract() -> str:
    branches = []
    for place, name in enumerate(COLUMNS):
        if name not in CONTRACT_OPTIONAL:
            branches.append((place, f"trim({name}) = ''", f"'is required and cannot be empty.'"))
        if name in CONTRACT_NUMBERS:
            number = f"try_cast(trim({name}) AS BIGINT)"
            whole = f"regexp_full_match(trim({name}), '[+-]?[0-9]+')"
            branches.append((place, f"trim({name}) <> '' AND NOT {whole}", f"'expects an integer but got ''' || trim({name}) || ''''"))
            branches.append((place, f"{whole} AND {number} < 0", f"'must be >= 0, got ' || trim({name}) || '.'"))
        if name in CONTRACT_LISTS:
            allowed = ", ".join(f"'{v.lower()}'" for v in CONTRACT_LISTS[name])
            branches.append((
                place, f"trim({name}) <> '' AND lower(trim({name})) NOT IN ({allowed})",
                f"'has value ''' || trim({name}) || ''' outside allowed values [{', '.join(CONTRACT_LISTS[name])}].'",
            ))
    names = COLUMNS
    return "\n  UNION ALL\n".join(
        f"  SELECT row_id + 1 AS row_number, {i} AS place, 'Row ' || (row_id + 1) || ': column ''{names[place]}'' ' || {text} AS error FROM raw WHERE {test}"
        for i, (place, test, text) in enumerate(branches)
    )


CONTRACT = f"""
broken AS (
{_contract()}),
listed AS (
  SELECT row_number, (row_number() OVER (PARTITION BY row_number ORDER BY place) - 1)::INT AS position, error,
    row_number() OVER (ORDER BY row_number, place) AS overall FROM broken)"""

RUNS = f"""
metrics AS (
  SELECT 'run-' || day AS run_id, count(*) FILTER (error_reason IS NULL) AS processed_records,
    count(*) FILTER (error_reason IS NOT NULL) AS invalid_records,
    {ratio('count(*) FILTER (error_reason IS NOT NULL)', 'count(*)', 6)} AS invalid_rate, 0::BIGINT AS high_risk_devices
  FROM checked GROUP BY day),
checks AS (
  SELECT run_id, 'processed_records_present' AS check_name, CASE WHEN processed_records >= 1 THEN 'pass' ELSE 'fail' END AS check_status,
    CASE WHEN processed_records >= 1 THEN 'low' ELSE 'high' END AS severity, 'processed_records' AS metric_name,
    processed_records::DOUBLE AS metric_value, 1.0::DOUBLE AS threshold_value,
    'Processed record count ' || processed_records || CASE WHEN processed_records >= 1 THEN ' meets' ELSE ' is below' END || ' the minimum threshold of 1.' AS message
  FROM metrics
  UNION ALL
  SELECT run_id, 'invalid_rate_threshold', CASE WHEN invalid_rate <= 0.08 THEN 'pass' ELSE 'fail' END,
    CASE WHEN invalid_rate <= 0.08 THEN 'low' ELSE 'medium' END, 'invalid_rate', invalid_rate, 0.08,
    'Invalid rate ' || printf('%.6f', invalid_rate) || CASE WHEN invalid_rate <= 0.08 THEN ' is within' ELSE ' exceeds' END || ' the threshold of 0.080000.'
  FROM metrics),
alerts AS (
  SELECT replace(run_id[5:14], '-', '')::BIGINT AS id, run_id, check_name AS alert_type,
    CASE WHEN severity = 'high' THEN 'critical' ELSE 'warning' END AS alert_level, message AS alert_message,
    'observability_writer' AS source, false AS is_published_to_kafka, run_id[5:14]::TIMESTAMP + INTERVAL 2 HOUR AS created_at
  FROM checks WHERE check_status = 'fail'),
audit AS (
  SELECT replace(m.run_id[5:14], '-', '')::BIGINT AS id, m.run_id, 'iot_local_pipeline' AS pipeline_name, 'local' AS environment,
    m.run_id[5:14]::TIMESTAMP AS started_at, m.run_id[5:14]::TIMESTAMP + INTERVAL 1 HOUR AS finished_at,
    CASE WHEN n.failing = 0 THEN 'success' ELSE 'warning' END AS status, processed_records, invalid_records, invalid_rate,
    high_risk_devices, n.failing AS total_alerts, m.run_id[5:14]::TIMESTAMP + INTERVAL 2 HOUR AS created_at
  FROM metrics m JOIN (SELECT run_id, count(*) FILTER (check_status = 'fail') AS failing FROM checks GROUP BY 1) n USING (run_id)),
stored_checks AS (
  SELECT replace(run_id[5:14], '-', '')::BIGINT * 2 + CASE WHEN check_name = 'invalid_rate_threshold' THEN 1 ELSE 0 END AS id, *,
    run_id[5:14]::TIMESTAMP + INTERVAL 2 HOUR AS created_at FROM checks)"""

_PROFILES = ", ".join(f"'{p}'" for p in PROFILES)
TIMED = f"""
timed AS (
  SELECT 'run-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS file,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, ([{_PROFILES}])[l_partkey % 3 + 1] AS profile,
    (l_suppkey % 4 + 1) * 1000 AS rows, (l_suppkey % 2 + 1) * 1000 AS consumer_messages, 5000::BIGINT AS loader_messages,
    l_returnflag = 'R' AS dry_run,
    l_quantity::BIGINT::DOUBLE AS s1, (round(l_discount * 100) * 3)::DOUBLE AS s2, (round(l_tax * 100) * 4)::DOUBLE AS s3, l_linenumber::DOUBLE AS s4
  FROM lineitem),
timed2 AS (
  SELECT *, s1 + s2 + s3 + s4 AS total_elapsed_seconds,
    CASE WHEN dry_run THEN 'not meaningful (dry-run)'
         WHEN s1 >= greatest(s2, s3, s4) THEN 'go-producer' WHEN s2 >= greatest(s3, s4) THEN 'python-consumer'
         WHEN s3 >= s4 THEN 'warehouse-loader' ELSE 'anomaly-detection' END AS slowest_step
  FROM timed)"""

STEPS = "go-producer|s1 python-consumer|s2 warehouse-loader|s3 anomaly-detection|s4".split()
_STEP_ROWS = " UNION ALL ".join(
    f"SELECT '{s.split('|')[0]}' AS name, {i} AS place, coalesce(sum({s.split('|')[1]}), 0) AS elapsed_seconds FROM {{source}}"
    for i, s in enumerate(STEPS)
)

OBJECTS = f"""
addressed AS (
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host,
    CASE WHEN page_id % 11 = 0 THEN '' ELSE (['raw/', 'Processed/', 'misc/', '', 'a/curated/'])[page_id % 5 + 1]
      || replace(regexp_extract(url, '^[a-z]+://[^/]+/?(.*)$', 1), '?', ' ')
      || (['.csv', '.PARQUET', '.jsonl', '.txt', '', '.json', '/'])[page_id % 7 + 1] END AS path,
    CASE WHEN page_id % 13 = 0 THEN 'unsupported_event' WHEN page_id % 2 = 0 THEN 's3_event' ELSE 'direct_event' END AS source_type
  FROM pages),
details AS (
  SELECT page_id, source_type, CASE WHEN source_type <> 'unsupported_event' THEN host END AS bucket,
    CASE WHEN source_type <> 'unsupported_event' THEN nullif(path, '') END AS object_key,
    CASE WHEN source_type = 's3_event' THEN 'put' END AS event_name,
    CASE source_type WHEN 's3_event' THEN 2 WHEN 'direct_event' THEN 1 END AS record_count FROM addressed),
described AS (
  SELECT page_id, object_key, string_split(object_key, '/')[-1] AS filename,
    regexp_extract(lower(string_split(object_key, '/')[-1]), '^.+(\\.[^.]*)$', 1) AS file_extension,
    rtrim(array_to_string(string_split(object_key, '/')[:-2], '/'), '/') AS key_directory,
    [lower(trim(x)) FOR x IN string_split(object_key, '/') IF lower(trim(x)) IN ({quote_list(LAYERS)})][1] AS detected_layer
  FROM details)"""

BASE = [RAW, CHECKED, TABLES, MARTS, FOUND]


def _with(parts, final: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + final


def _logs(final: str, *more: str) -> str:
    return _with([*BASE, *more], final)


def _raw(final: str, *more: str) -> str:
    return _with([RAW, *more], final)


def _runs(final: str) -> str:
    return _with([RAW, CHECKED, RUNS], final)


_CATEGORY = """CASE WHEN lower(error_reason) LIKE 'invalid json%' THEN 'invalid_json'
    WHEN lower(error_reason) LIKE '%missing required field%' THEN 'missing_required_field'
    WHEN lower(error_reason) LIKE '%invalid timestamp%' THEN 'invalid_timestamp'
    WHEN lower(error_reason) LIKE '%invalid protocol%' THEN 'invalid_protocol'
    WHEN lower(error_reason) LIKE '%packet_size%' THEN 'invalid_packet_size'
    WHEN lower(error_reason) LIKE '%duration_ms%' THEN 'invalid_duration'
    WHEN lower(error_reason) LIKE '%event_type%' THEN 'invalid_event_type' ELSE 'other' END"""
_RECENT = "FROM processed ORDER BY coalesce(processed_at, inserted_at, event_timestamp) DESC NULLS LAST, id DESC LIMIT 1000"
_NORMAL = """normal AS (
  SELECT try_strptime(trim(event_timestamp), '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp, trim(device_id) AS device_id,
    upper(trim(protocol)) AS protocol, try_cast(packet_size AS BIGINT) AS packet_size, try_cast(duration_ms AS DOUBLE) AS duration_ms,
    lower(trim(event_type)) AS event_type, nullif(trim(attack_type), '') AS attack_type, lower(trim(status)) AS status FROM raw)"""
_ATTACK_RAW = "count(*) FILTER (event_type = 'attack' OR attack_type IS NOT NULL)"
_FAIL_RAW = "count(*) FILTER (status IN ('failed', 'error'))"
_DEVICE_ORDER = "CASE risk_level WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END, attack_rate DESC, total_events DESC, device_id"
_IN_FILE = "row_number() OVER (PARTITION BY row_id % 3 ORDER BY row_id) + 1"
_ODD = "run_id[13:14]::INT % 2 = 1"
_ACCEPTED = "regexp_full_match(packet_size, '[+-]?[0-9]+')"
_LATEST = "(SELECT run_id FROM audit ORDER BY created_at DESC, finished_at DESC, run_id DESC LIMIT 1)"
_STAGES = (
    ("data_contract_validation", 1), ("producer", 2), ("consumer", 3), ("warehouse_loader", 4), ("anomaly_detection", 5), ("postgresql_verification", 6),
)


_NORMAL_SECONDS = _NORMAL.replace("try_strptime(trim(event_timestamp), '%Y-%m-%dT%H:%M:%S.%fZ')", "date_trunc('second', try_strptime(trim(event_timestamp), '%Y-%m-%dT%H:%M:%S.%fZ'))")


# the declared tests of every model, written out here: columns that must not be null, must be unique, must be in a list
_DECLARED = {
    ("stg_processed_iot_logs", "staged"): (
        "id event_timestamp event_date event_hour device_id source_ip destination_ip protocol packet_size duration_ms event_type status "
        "processed_at inserted_at is_attack is_failed", "id",
        {"protocol": "'TCP', 'UDP', 'ICMP'", "event_type": "'normal', 'warning', 'error', 'attack'", "status": "'success', 'failed', 'blocked'"},
    ),
    ("stg_invalid_iot_logs", "invalid"): ("id raw_payload error_reason failed_at inserted_at", "id", {}),
    ("mart_device_risk_summary", "risk"): (
        "device_id total_events attack_events failed_events attack_rate failure_rate first_seen last_seen risk_level", "device_id",
        {"risk_level": "'LOW', 'MEDIUM', 'HIGH'"},
    ),
    ("mart_attack_summary", "attacks"): ("attack_type total_attack_events affected_devices first_seen last_seen", "", {}),
    ("mart_protocol_metrics", "protocols"): ("protocol total_events attack_events failed_events attack_rate first_seen last_seen", "", {}),
    ("mart_pipeline_quality_summary", "quality"): ("processed_records invalid_records total_records invalid_rate", "", {}),
}


def _some_declared(test: str, *models: str) -> str:
    return f"SELECT model, column_name, test, failures FROM ({_all_declared()}) WHERE test = '{test}' AND model IN ({quote_list(models)})"


def _all_declared() -> str:
    rows = []
    for (model, table), (present, single, listed) in _DECLARED.items():
        tests = [(c, "not_null", f"(SELECT count(*) FROM {table} WHERE {c} IS NULL)") for c in present.split()]
        tests += [(c, "accepted_values", f"(SELECT count(*) FROM {table} WHERE {c} NOT IN ({v}))") for c, v in listed.items()]
        tests += [(c, "unique", f"(SELECT count(*) FROM (SELECT {c} FROM {table} GROUP BY {c} HAVING count({c}) > 1))") for c in single.split()]
        rows += [f"SELECT '{model}' AS model, '{c}' AS column_name, '{t}' AS test, {n} AS failures" for c, t, n in tests]
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({' UNION ALL '.join(rows)})"


def _counts(field: str) -> str:
    return (
        f"(SELECT coalesce(string_agg(v || '=' || n, ',' ORDER BY v), '') FROM (SELECT {field} AS v, count(*) AS n FROM found GROUP BY 1)) "
    )


_FEATURES_SQL = f"""SELECT *, CASE WHEN attack_event_ratio >= 0.5 OR failed_event_ratio >= 0.5 THEN 'high'
        WHEN attack_event_ratio > 0 OR failed_event_ratio > 0 THEN 'medium' ELSE 'low' END AS risk_level FROM (
      SELECT device_id, count(*) AS total_events, count(DISTINCT protocol) AS unique_protocols, sum(packet_size)::BIGINT AS total_packet_size,
        {mean('packet_size')} AS avg_packet_size, max(packet_size) AS max_packet_size, {mean('duration_ms')} AS avg_duration_ms,
        max(duration_ms) AS max_duration_ms, {_FAIL_RAW} AS failed_events, count(*) FILTER (status = 'success') AS success_events,
        {ratio(_FAIL_RAW, 'count(*)', 4)} AS failed_event_ratio, {_ATTACK_RAW} AS attack_events, {ratio(_ATTACK_RAW, 'count(*)', 4)} AS attack_event_ratio,
        min(event_timestamp) AS first_event_timestamp, max(event_timestamp) AS last_event_timestamp FROM normal GROUP BY device_id)"""
_DEVICE_FEATURES = _raw(_FEATURES_SQL, _NORMAL)


def _full_run() -> str:
    """Stage counts of the whole run. Messages come from parsed rows, so every body is JSON, a blank
    status is still a key, and rows without an integer size are not sent."""
    sent = f"""sent AS (SELECT *, {_ACCEPTED} AS fits, upper(trim(protocol)) IN ('TCP', 'UDP', 'ICMP') AND trim(status) <> '' AND packet_size <> '-1'
        AND event_timestamp <> 'not-a-timestamp' AND event_type <> 'reboot' AS ok FROM raw),
      kept AS (SELECT *, packet_size::INT AS size, duration_ms::INT AS span, trim(attack_type) AS label FROM sent WHERE fits AND ok),
      named AS (SELECT *, lower(event_type) = 'attack' OR label <> '' AS is_attack FROM kept)"""
    stages = {
        "contract_errors": "(SELECT count(*) FROM broken)",
        "reported_errors": "(SELECT count(*) FROM broken)",
        "raw_messages": "(SELECT count(*) FROM sent WHERE fits)",
        "reconciled_rows": "(SELECT count(*) FROM sent WHERE fits)",
        "processed_rows": "(SELECT count(*) FROM kept)",
        "invalid_rows": "(SELECT count(*) FROM sent WHERE fits AND NOT ok)",
        **dict.fromkeys(("anomalies", "reported_anomalies"), f"""(SELECT coalesce(sum((size >= 1000)::INT + (span >= 5000)::INT + (lower(status) IN ('blocked', 'failed', 'error'))::INT
          + (lower(label) NOT IN ({quote_list(BENIGN_LABELS)}))::INT + (protocol = 'icmp')::INT), 0)::BIGINT FROM kept)"""),
        "mart_device_risk_summary": "(SELECT count(DISTINCT device_id) FROM kept)",
        "mart_attack_summary": "(SELECT count(DISTINCT CASE WHEN label = '' THEN 'unknown' ELSE label END) FROM named WHERE is_attack)",
        "mart_protocol_metrics": "(SELECT count(DISTINCT upper(trim(protocol))) FROM kept)",
        "mart_pipeline_quality_summary": "1",
        "failed_tests": "(SELECT (count(*) FILTER (lower(status) NOT IN ('success', 'failed', 'blocked')) > 0)::INT FROM kept)",
        "feature_rows": "(SELECT count(DISTINCT device_id) FROM normal)",
        "quality_checks": "2",
    }
    return _raw(" UNION ALL ".join(f"SELECT '{k}' AS stage, ({v})::BIGINT AS row_count" for k, v in stages.items()), CONTRACT, sent, _NORMAL)


def _gated_run() -> str:
    """What a run over the rows without contract errors stores, as (table, row, values)."""
    kept = f"""clean AS (SELECT * FROM raw WHERE row_id + 1 NOT IN (SELECT row_number FROM broken)),
      sent AS (SELECT *, trim(device_id) AS device, upper(trim(protocol)) AS proto, lower(trim(event_type)) AS kind, lower(trim(status)) AS state,
        packet_size::INT AS size, duration_ms::INT AS span, trim(attack_type) AS label FROM clean),
      kept AS (SELECT *, kind = 'attack' OR label <> '' AS hit, state IN ('failed', 'error') AS lost FROM sent
        WHERE proto IN ('TCP', 'UDP', 'ICMP') AND event_timestamp <> 'not-a-timestamp' AND kind <> 'reboot' AND size >= 0),
      device AS (SELECT device, count(*) AS n, count(*) FILTER (hit) AS hits, count(*) FILTER (lost) AS losses FROM kept GROUP BY 1),
      rated AS (SELECT *, greatest({ratio('hits', 'n', 4)}, {ratio('losses', 'n', 4)}) AS worst FROM device),
      finding AS (SELECT unnest([
          CASE WHEN size >= 1500 THEN 'high_packet_size|high' WHEN size >= 1000 THEN 'high_packet_size|medium' END,
          CASE WHEN span >= 15000 THEN 'high_duration|high' WHEN span >= 5000 THEN 'high_duration|medium' END,
          CASE WHEN state = 'blocked' THEN 'failed_or_blocked_status|high' WHEN state IN ('failed', 'error') THEN 'failed_or_blocked_status|medium' END,
          CASE WHEN lower(label) IN ({quote_list(BENIGN_LABELS)}) THEN NULL WHEN replace(lower(label), 'poisioning', 'poisoning') IN ({quote_list(HIGH_RISK_LABELS)})
            THEN 'suspicious_attack_type|high' ELSE 'suspicious_attack_type|medium' END,
          CASE WHEN proto = 'ICMP' THEN 'unusual_protocol|low' END]) AS rule FROM kept),
      total AS (SELECT (SELECT count(*) FROM kept) AS good, (SELECT count(*) FROM sent) AS n),
      share AS (SELECT *, {ratio('n - good', 'n', 6)} <= 0.08 AS few FROM total)"""
    parts = (
        "SELECT 'mart_device_risk_summary' AS \"table\", device AS row, concat_ws('|', n, hits, losses, CASE WHEN worst >= 0.5 THEN 'HIGH' WHEN worst >= 0.2 THEN 'MEDIUM' ELSE 'LOW' END) AS values FROM rated",
        "SELECT 'mart_protocol_metrics', proto, concat_ws('|', count(*), count(*) FILTER (hit), count(*) FILTER (lost)) FROM kept GROUP BY proto",
        "SELECT 'mart_attack_summary', CASE WHEN label = '' THEN 'unknown' ELSE label END, concat_ws('|', count(*), count(DISTINCT device)) FROM kept WHERE hit GROUP BY 2",
        "SELECT 'device_features', device, count(*)::VARCHAR FROM sent GROUP BY device",
        "SELECT 'processed_iot_logs', source_ip, concat_ws('|', device, proto, size, span, kind, state) FROM kept",
        "SELECT 'iot_anomalies', split_part(rule, '|', 1), concat_ws('|', split_part(rule, '|', 2), count(*)) FROM finding WHERE rule IS NOT NULL GROUP BY rule",
        "SELECT 'pipeline_quality_checks', 'processed_records_present', CASE WHEN good >= 1 THEN 'pass|low' ELSE 'fail|high' END FROM share",
        "SELECT 'pipeline_quality_checks', 'invalid_rate_threshold', CASE WHEN few THEN 'pass|low' ELSE 'fail|medium' END FROM share",
        "SELECT 'pipeline_alerts', 'invalid_rate_threshold', 'warning|true' FROM share WHERE NOT few",
        "SELECT 'pipeline_run_audit', 'run-all', concat_ws('|', CASE WHEN few THEN 'success' ELSE 'warning' END, good, n - good, CASE WHEN few THEN 0 ELSE 1 END) FROM share",
    )
    return _raw(" UNION ALL ".join(parts), CONTRACT, kept)


_PAYLOADS = """SELECT run_id, alert_type, '{"run_id":"' || run_id || '","pipeline_name":"iot_local_pipeline","environment":"local","alert_type":"' || alert_type
              || '","alert_level":"' || alert_level || '","alert_message":"' || alert_message || '","source":"' || source || '","processed_records":' || processed_records
              || ',"invalid_records":' || invalid_records || ',"invalid_rate":' || invalid_rate::VARCHAR || ',"created_at":"' || strftime(created_at, '%Y-%m-%dT%H:%M:%S+00:00') || '"}' AS value
              FROM alerts JOIN metrics USING (run_id)"""


def statements() -> dict[str, str]:
    columns = ", ".join(COLUMNS)
    json_row = " || ".join(
        [f"'{'{' if i == 0 else ','}\"{c}\":' || " + (c if c in ("packet_size", "duration_ms") else f"'\"' || {c} || '\"'") for i, c in enumerate(COLUMNS)]
        + [f"',\"ingestion_timestamp\":\"{AS_OF_TEXT}\"}}'"]
    )
    steps, real_steps = _STEP_ROWS.format(source="timed2"), _STEP_ROWS.format(source="timed2 WHERE NOT dry_run")
    return {
        "s5_row_cap": _raw(f"SELECT row_id, {columns} FROM raw WHERE {_ACCEPTED} ORDER BY row_id LIMIT 1000"),
        "s9_decode": _raw("SELECT row_id, CASE WHEN NOT json_valid(value) THEN 'bad_json' WHEN json_type(value) = 'OBJECT' THEN 'object' ELSE 'other' END AS payload_kind FROM msg"),
        "s10_recent_rows": _logs(f"SELECT s.* FROM shaped s JOIN (SELECT id {_RECENT}) r ON s.source_row_id = r.id"),
        "p1_normalize": _raw("SELECT * FROM normal", _NORMAL),
        "p2_raw_message": _raw(f"SELECT row_id, device_id AS key, {json_row} AS value FROM (SELECT row_id, {', '.join(f'{c}' if c in ('packet_size', 'duration_ms') else c for c in COLUMNS)} FROM raw WHERE {_ACCEPTED})"),
        "f1_missing_fields": _logs("SELECT row_id, missing AS error_reason FROM checked WHERE missing <> '' AND j IS NOT NULL"),
        "f6_validate": _logs("SELECT row_id, value AS raw_text, error_reason FROM checked"),
        "p3_normalized": _logs(f"SELECT row_id, event_timestamp, device_id, source_ip, destination_ip, protocol, packet_size, duration_ms, event_type, status, attack_type, ingestion_text AS ingestion_timestamp, value AS raw_text, {AS_OF} AS processed_at FROM good"),
        "p4_map_processed": _logs("SELECT * FROM processed"),
        "p5_map_invalid": _logs("SELECT * REPLACE (trim(raw_payload) AS raw_payload) FROM invalid"),
        "s8_topic_route": _logs("SELECT CASE WHEN error_reason IS NULL THEN 'iot_processed_logs' ELSE 'iot_invalid_logs' END AS topic, count(*) AS messages, count(DISTINCT CASE WHEN error_reason IS NULL THEN device_id END) AS keys FROM checked GROUP BY 1"),
        "p6_stage_processed": _logs("SELECT * FROM staged"),
        "p7_stage_invalid": _logs(f"SELECT *, {_CATEGORY} AS error_category FROM invalid"),
        "p14_rule_input": _logs("SELECT * FROM shaped"),
        "p15_display": _logs("SELECT * REPLACE (first_seen::VARCHAR AS first_seen, last_seen::VARCHAR AS last_seen) FROM protocols"),
        "a2_device_risk": _logs("SELECT * FROM risk"),
        "a3_attack_summary": _logs("SELECT * FROM attacks"),
        "a4_protocol_metrics": _logs("SELECT * FROM protocols"),
        "a5_quality_summary": _logs("SELECT * FROM quality"),
        "a6_run_metrics": _logs(f"SELECT 'run-all' AS run_id, processed_records, invalid_records, coalesce({ratio('invalid_records', 'total_records', 6)}, 0) AS invalid_rate, 0::BIGINT AS high_risk_devices FROM quality"),
        "a23_protocol_volume": _logs("SELECT protocol, count(*) AS event_count, sum(packet_size)::BIGINT AS total_bytes_sent FROM staged GROUP BY protocol"),
        "j3_table_counts": _logs("SELECT (SELECT count(*) FROM processed) AS processed_count, (SELECT count(*) FROM invalid) AS invalid_count"),
        "q6_anomalies": _logs("SELECT * FROM found"),
        "q6_recent_anomalies": _logs(f"SELECT f.* FROM found f JOIN (SELECT id {_RECENT}) r ON f.source_row_id = r.id"),
        "q5_unusual_protocol": _raw(
            """SELECT severity, score, reason, count(*) AS anomalies FROM (
              SELECT CASE WHEN protocol = 'ICMP' THEN 'low' ELSE 'high' END AS severity, CASE WHEN protocol = 'ICMP' THEN 35 ELSE 80 END AS score,
                'protocol=' || protocol || CASE WHEN protocol = 'ICMP' THEN ' is allowed but treated as less common control-plane traffic.'
                  ELSE ' is outside the expected set [''ICMP'', ''TCP'', ''UDP''].' END AS reason FROM normal WHERE protocol NOT IN ('TCP', 'UDP')) GROUP BY ALL""",
            _NORMAL,
        ),
        "a7_by_rule": _logs("SELECT rule_name, count(*) AS anomalies FROM found GROUP BY 1"),
        "a7_by_severity": _logs("SELECT severity, count(*) AS anomalies FROM found GROUP BY 1"),
        "a8_affected_rows": _logs("SELECT count(DISTINCT source_row_id) AS rows_with_anomalies FROM found"),
        "a9_summary": _logs(f"SELECT (SELECT count(*) FROM processed) AS rows_scanned, (SELECT count(*) FROM found) AS anomalies_detected, (SELECT count(DISTINCT source_row_id) FROM found) AS rows_with_anomalies, {_counts('rule_name')} AS anomalies_by_rule, {_counts('severity')} AS anomalies_by_severity"),
        "a9_anomaly_runs": _logs(
            f"""SELECT * FROM (SELECT (SELECT count(*) FROM processed) AS rows_scanned, (SELECT count(*) FROM found) AS anomalies_detected,
                (SELECT count(DISTINCT source_row_id) FROM found) AS rows_with_anomalies, {_counts('rule_name')} AS anomalies_by_rule, {_counts('severity')} AS anomalies_by_severity),
              (SELECT 'run-dry' AS run_id, true AS dry_run, false AS write_db, 0::BIGINT AS inserted_rows UNION ALL SELECT 'run-stored', false, true, (SELECT count(*) FROM found))"""
        ),
        "k10_stored_anomalies": _logs(
            f"""SELECT row_number() OVER (ORDER BY source_row_id::BIGINT, list_position({RULES}, rule_name)) AS id, * REPLACE ('run-stored' AS run_id, {AS_OF} AS created_at) FROM stored"""
        ),
        "a10_rule_severity": _logs("SELECT rule_name, severity, count(*) AS anomaly_rows FROM found GROUP BY ALL"),
        "a11_per_run": _logs("SELECT run_id, count(*) AS anomaly_rows FROM stored GROUP BY 1 ORDER BY run_id DESC LIMIT 5"),
        "j2_latest_run": _logs("SELECT run_id, rule_name, severity, count(*) AS anomaly_rows FROM stored WHERE run_id = (SELECT run_id FROM stored ORDER BY created_at DESC, run_id DESC LIMIT 1) GROUP BY ALL"),
        "k10_anomaly_rows": _logs("SELECT * FROM stored"),
        "q8_contract_errors": _raw("SELECT row_number, position, error FROM listed", CONTRACT),
        "a13_contract_totals": _raw("SELECT count(*) AS rows_checked, count(*) FILTER (n IS NULL) AS valid_rows, count(n) AS invalid_rows, coalesce(sum(n), 0)::BIGINT AS error_count FROM raw LEFT JOIN (SELECT row_number, count(*) AS n FROM broken GROUP BY 1) b ON b.row_number = row_id + 1", CONTRACT),
        "w3_error_cap": _raw("SELECT row_number, position, error FROM listed WHERE overall <= 50", CONTRACT),
        "q9_contract_job": _raw(
            """SELECT count(*) AS rows_checked, count(*) FILTER (n IS NULL) AS valid_rows, count(n) AS invalid_rows, coalesce(sum(n), 0)::BIGINT AS error_count, false AS stopped_early
              FROM raw LEFT JOIN (SELECT row_number, count(*) AS n FROM broken GROUP BY 1) b ON b.row_number = row_id + 1""",
            CONTRACT,
        ),
        "p1_normalize_seconds": _raw("SELECT * FROM normal", _NORMAL_SECONDS),
        "q10_q12_all_models": _logs(_all_declared()),
        "q10_not_null": _logs(_some_declared("not_null", "stg_processed_iot_logs")),
        "q11_unique": _logs(_some_declared("unique", "stg_processed_iot_logs", "mart_device_risk_summary")),
        "q12_accepted_values": _logs(_some_declared("accepted_values", "stg_processed_iot_logs", "mart_device_risk_summary")),
        "q13_checks": _runs("SELECT * FROM checks"),
        "q14_alerts": _runs("SELECT * FROM alerts"),
        "q15_audit": _runs("SELECT * FROM audit"),
        "k12_upsert": _runs(
            f"""SELECT * EXCLUDE (kept, kept_at) REPLACE (CASE WHEN kept IS NULL THEN id * 100 ELSE kept END AS id, coalesce(kept_at, {AS_OF}) AS created_at)
              FROM (SELECT *, CASE WHEN {_ODD} THEN id * 10 END AS kept, CASE WHEN {_ODD} THEN created_at END AS kept_at FROM audit WHERE run_id[13:14]::INT % 3 = 0)
              UNION ALL
              SELECT * EXCLUDE (copy) REPLACE (id * 10 + copy AS id, 0::BIGINT AS processed_records, created_at + copy * INTERVAL 1 DAY AS created_at)
              FROM audit, (VALUES (0), (1)) AS c(copy) WHERE {_ODD} AND run_id[13:14]::INT % 3 <> 0"""
        ),
        "w1_keep_first": _runs("SELECT * REPLACE (id * 10 + 1 AS id) FROM audit"),
        "k13_replace": _runs(f"SELECT * REPLACE (CASE WHEN {_ODD} THEN 'rewritten' ELSE severity END AS severity) FROM stored_checks"),
        "k14_replace_empty": _runs(f"SELECT * FROM alerts WHERE NOT ({_ODD})"),
        "k15_mark_published": _runs("SELECT * REPLACE (run_id = (SELECT max(run_id) FROM alerts) AS is_published_to_kafka) FROM alerts"),
        "p16_alert_payload": _runs(_PAYLOADS),
        "k16_alert_topic": _runs(f"SELECT 'iot_pipeline_alerts' AS topic, NULL::VARCHAR AS key, value FROM ({_PAYLOADS}) WHERE run_id = (SELECT max(run_id) FROM alerts)"),
        "k15_stored_flag": _runs("SELECT * REPLACE (run_id = (SELECT max(run_id) FROM alerts) AS is_published_to_kafka) FROM alerts"),
        "k7_offsets": _raw("SELECT 'iot_raw_logs' AS topic, length(key) + row_id % 8 AS partition, max(row_id // 8) + 1 AS next_offset FROM msg GROUP BY ALL"),
        "t5_recent_runs": _runs("SELECT * FROM audit ORDER BY created_at DESC, finished_at DESC NULLS LAST, run_id DESC LIMIT 20"),
        "t5_recent_checks": _runs("SELECT * FROM stored_checks ORDER BY created_at DESC, id DESC LIMIT 100"),
        "t5_recent_alerts": _runs("SELECT * FROM alerts ORDER BY created_at DESC, id DESC LIMIT 50"),
        "t6_latest": _runs(f"SELECT * FROM audit WHERE run_id = {_LATEST}"),
        "f9_latest_checks": _runs(f"SELECT * FROM stored_checks WHERE run_id = {_LATEST}"),
        "f10_run_prefix": _runs("SELECT run_id, status, processed_records FROM audit WHERE starts_with(run_id, 'run-2024-01-1')"),
        "p19_run_numbers": _runs(f"SELECT run_id, status, processed_records, invalid_records, high_risk_devices, total_alerts, printf('%.2f%%', invalid_rate * 100) AS invalid_rate, environment FROM audit WHERE run_id = {_LATEST}"),
        "p19_overview": _logs("SELECT processed_records, invalid_records, total_records, printf('%.2f%%', invalid_rate * 100) AS invalid_rate FROM quality"),
        "a14_reconcile": _logs("SELECT count(*) FILTER (error_reason IS NULL) AS processed_delta, count(*) FILTER (error_reason IS NOT NULL) AS invalid_delta, count(*) AS expected_rows, count(*) AS total_delta, 'passed' AS status FROM checked WHERE row_id % 2 = 1"),
        "a15_bounded_count": _raw("SELECT least(count(*), 5000) AS row_count FROM raw"),
        "a27_preflight": _raw("SELECT 'full' AS profile, count(*) AS available_rows, least(count(*), 1000000000) AS bounded_rows, CASE WHEN count(*) < 1000000000 THEN 'failed' ELSE 'passed' END AS status FROM raw UNION ALL SELECT 'medium', count(*), least(count(*), 5000), 'passed' FROM raw"),
        "a16_status": _runs(
            """SELECT count(*) FILTER (check_status = 'pass') AS passed, count(*) FILTER (check_status = 'fail') AS failed, 0::BIGINT AS skipped, 0::BIGINT AS dry_run, 0::BIGINT AS other_statuses,
              CASE WHEN count(*) FILTER (check_status = 'fail' AND id % 2 = 1) > 0 THEN 'failed' ELSE 'passed' END AS overall_status,
              coalesce(string_agg(DISTINCT CASE WHEN check_status = 'fail' AND id % 2 = 1 THEN check_name END, ', '), '') AS required_failures FROM stored_checks"""
        ),
        "a17_stage_durations": " UNION ALL ".join(
            f"(SELECT '{stage}' AS stage, l_quantity AS duration_seconds FROM lineitem WHERE l_linenumber = {n} AND l_quantity <> 0 ORDER BY l_orderkey DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC LIMIT 1)"
            for stage, n in _STAGES
        ),
        "f8_filter": _logs("SELECT * FROM risk WHERE risk_level IN ('HIGH', 'LOW')"),
        "a12_risk_counts": _logs("SELECT level AS risk_level, (SELECT count(*) FROM risk WHERE risk_level = level) AS device_count FROM (VALUES ('HIGH'), ('MEDIUM'), ('LOW')) AS l(level)"),
        "t1_device_top": _logs(f"SELECT * FROM risk ORDER BY {_DEVICE_ORDER} LIMIT 10"),
        "t2_attack_top": _logs("SELECT * FROM attacks ORDER BY total_attack_events DESC, affected_devices DESC, attack_type LIMIT 5"),
        "t3_protocol_top": _logs("SELECT * FROM protocols ORDER BY total_events DESC, attack_events DESC, protocol LIMIT 5"),
        "u2_options": _logs("SELECT DISTINCT 'protocol' AS choice, protocol AS option FROM staged UNION ALL SELECT DISTINCT 'attack_type', attack_type FROM attacks UNION ALL SELECT DISTINCT 'risk_level', risk_level FROM risk"),
        "r1_first_n": _raw(f"SELECT row_id, {columns} FROM raw ORDER BY row_id LIMIT 2000"),
        "r2_random_n": _raw(
            f"""SELECT row_id, {columns} FROM raw ORDER BY ('0x' || substr(md5('42-' || row_id), 1, 15))::BIGINT, ('0x' || substr(md5('42-' || row_id), 16, 15))::BIGINT LIMIT 2000"""
        ),
        "p18_event_details": _with([OBJECTS], "SELECT * FROM details"),
        "p17_key_details": _with([OBJECTS], "SELECT * FROM described"),
        "f13_manifest_validity": _with(
            [OBJECTS],
            f"""SELECT page_id, CASE WHEN problem = '' THEN 'validated' ELSE 'invalid' END AS status, problem = '' AS is_valid, problem AS validation_errors FROM (
              SELECT page_id, CASE WHEN object_key IS NULL THEN '{MISSING_KEY}' WHEN file_extension IN ({quote_list(EXTENSIONS)}) THEN '' ELSE '{BAD_EXTENSION}' END AS problem FROM described)""",
        ),
        "t8_run_order": _with([TIMED], "SELECT file, timestamp, profile, rows FROM timed2 ORDER BY timestamp, file LIMIT 100"),
        "f12_profile_filter": _with([TIMED], "SELECT file, timestamp, rows FROM timed2 WHERE profile = 'medium'"),
        "a18_groups": _with([TIMED], "SELECT rows, consumer_messages, loader_messages, count(*) AS run_count FROM timed2 GROUP BY ALL"),
        "a19_step_share": _with([TIMED], f"SELECT name, elapsed_seconds, elapsed_seconds / sum(elapsed_seconds) OVER () * 100 AS share_percent FROM ({steps})"),
        "a20_profile_avg": _with([TIMED], "SELECT profile, count(*) AS run_count, count(*) FILTER (dry_run) AS dry_run_count, sum(total_elapsed_seconds) / count(*) AS average_total_seconds FROM timed2 GROUP BY profile"),
        "a21_bottleneck": _with(
            [TIMED],
            f"""SELECT (SELECT name FROM ({real_steps}) ORDER BY elapsed_seconds DESC, place LIMIT 1) AS dominant_step, slowest_step AS most_frequent_slowest, n AS slowest_runs,
              (SELECT count(*) FROM timed2 WHERE NOT dry_run) AS real_runs
              FROM (SELECT slowest_step, count(*) AS n, min(timestamp || file) AS first_run FROM timed2 WHERE NOT dry_run GROUP BY 1) ORDER BY n DESC, first_run LIMIT 1""",
        ),
        "a22_overview": _with(
            [TIMED],
            """SELECT count(*) AS run_count, count(*) FILTER (dry_run) AS dry_run_count, count(*) FILTER (NOT dry_run) AS real_run_count, 'full, medium, sample' AS profiles_included,
              (SELECT file FROM timed2 ORDER BY total_elapsed_seconds, timestamp, file LIMIT 1) AS fastest_run,
              (SELECT file FROM timed2 ORDER BY total_elapsed_seconds DESC, timestamp, file LIMIT 1) AS slowest_run FROM timed2""",
        ),
        "a26_run_table": _with([TIMED], "SELECT file, timestamp, profile, rows, consumer_messages, loader_messages, total_elapsed_seconds, CASE WHEN dry_run OR total_elapsed_seconds <= 0 THEN 'n/a' ELSE printf('%.2f', rows / total_elapsed_seconds) END AS throughput, slowest_step FROM timed2"),
        "w2_slowest": _with([TIMED], "SELECT slowest_step, count(*) AS run_count FROM timed2 GROUP BY 1"),
        "u3_profiles": _with([TIMED], "SELECT DISTINCT profile FROM timed2"),
        "s14_run_documents": _with(
            [TIMED],
            """SELECT file, ([NULL, 'timestamp must be a str.', 'profile must be one of: sample, medium, full.', 'rows must be an integer.', 'commands must contain at least one step.',
                'command.command must contain only strings.', 'total_elapsed_seconds must be numeric.'])[line] AS problem,
              CASE WHEN line = 1 THEN profile END AS profile, CASE WHEN line = 1 THEN rows END AS rows, CASE WHEN line = 1 THEN 4 END AS steps FROM (SELECT *, string_split(file, '-')[3]::INT AS line FROM timed2)""",
        ),
        "s3_lenient_scan": _raw(f"SELECT {', '.join(f'trim({c}) AS {c}' if c not in ('packet_size', 'duration_ms') else f'{c}::INT AS {c}' for c in COLUMNS)} FROM raw WHERE {_ACCEPTED}"),
        "s4_strict_scan": _raw(f"SELECT {', '.join(COLUMNS_AS_WRITTEN)} FROM raw"),
"w4_row_numbers": _raw(f"SELECT (row_id % 3)::VARCHAR AS file, {_IN_FILE} AS row_number, {', '.join(COLUMNS_AS_WRITTEN)} FROM raw"),
        "q9_contract_files": _raw(
            f"""SELECT (row_id % 3)::VARCHAR AS file, n AS row_number, position, regexp_replace(error, '^Row [0-9]+', 'Row ' || n) AS error
              FROM listed JOIN (SELECT row_id, row_id + 1 AS row_number, {_IN_FILE} AS n FROM raw) USING (row_number)""", CONTRACT
        ),
        "f15_contract_gate": _raw(
            """SELECT 'clean' AS files, 'passed' AS outcome
              UNION ALL SELECT 'all', 'contract check failed: ' || count(*) || ' error(s) in ' || count(DISTINCT row_number) || ' row(s)' FROM listed""", CONTRACT
        ),
        "x9_replayed_load": _logs(
            """SELECT step, CASE done WHEN 0 THEN 0 WHEN 1 THEN p1 ELSE p END AS processed_rows, CASE done WHEN 0 THEN 0 WHEN 1 THEN p1 ELSE p END AS processed_ids,
                CASE done WHEN 0 THEN 0 WHEN 1 THEN i1 ELSE i END AS invalid_rows, CASE done WHEN 0 THEN 0 WHEN 1 THEN i1 ELSE i END AS invalid_ids
              FROM (VALUES ('crash of the first batch', 0), ('first batch', 1), ('crash of the second batch', 1), ('second batch', 2), ('first batch again', 2),
                ('crash of the first batch again', 2)) v(step, done),
              (SELECT count(*) FILTER (error_reason IS NULL) AS p, count(*) FILTER (error_reason IS NOT NULL) AS i,
                count(*) FILTER (error_reason IS NULL AND row_id % 2 = 1) AS p1, count(*) FILTER (error_reason IS NOT NULL AND row_id % 2 = 1) AS i1 FROM checked)"""
        ),
        "k12_stored_audit": _runs(
            f"""SELECT * REPLACE (CASE run_id WHEN (SELECT min(run_id) FROM audit) THEN 7 WHEN (SELECT max(run_id) FROM audit) THEN 8 ELSE processed_records END AS processed_records) FROM audit
              UNION ALL SELECT * REPLACE ('run-new' AS run_id, (SELECT max(id) FROM audit) + 1 AS id, {AS_OF} AS created_at, 9 AS processed_records)
              FROM audit WHERE run_id = (SELECT max(run_id) FROM audit)"""
        ),
        "k13_stored_checks": _runs(
            """SELECT * EXCLUDE (place, newest) REPLACE (CASE WHEN newest THEN 'rewritten' ELSE severity END AS severity,
                CASE WHEN newest THEN (SELECT max(id) FROM stored_checks WHERE run_id <> (SELECT max(run_id) FROM stored_checks)) + place ELSE id END AS id)
              FROM (SELECT *, run_id = (SELECT max(run_id) FROM stored_checks) AS newest, row_number() OVER (PARTITION BY run_id ORDER BY check_name) AS place FROM stored_checks)"""
        ),
        "k14_stored_alerts": _runs("SELECT * FROM alerts WHERE run_id <> (SELECT max(run_id) FROM alerts)"),
        "k16_undelivered": _runs(
            """SELECT run_id, alert_type, false AS is_published_to_kafka, n || ' of ' || n || ' alerts of run ' || run_id || ' were not delivered' AS outcome
              FROM alerts JOIN (SELECT run_id, count(*) AS n FROM alerts GROUP BY 1) USING (run_id) WHERE run_id = (SELECT max(run_id) FROM alerts)"""
        ),
        "k1_delivery": _raw(
            """SELECT count(*) FILTER (size <= 260) AS sent, count(*) FILTER (size > 260) AS failed, count(*) FILTER (size <= 260) AS held,
                max(CASE WHEN size <= 260 THEN strlen(value) END)::INT AS largest FROM (SELECT value, strlen(value) + strlen(key) AS size FROM msg)"""
        ),
        "x3_bounded_reads": _raw(
            """SELECT CASE WHEN place <= 300 THEN 1 WHEN place <= 450 THEN 2 ELSE 3 END AS read, 'iot_raw_logs' AS topic, row_id % 5 AS partition, row_id // 5 AS "offset", row_id
              FROM (SELECT row_id, row_number() OVER (ORDER BY row_id % 5, row_id // 5) AS place FROM raw)"""
        ),
        "j2_catalog_latest": _logs(
            """SELECT run_id, rule_name, severity, count(*) AS anomaly_rows, 'pipeline_alerts=missing' AS absent FROM stored
              WHERE run_id = (SELECT 'anomaly-' || max(day) FROM checked) GROUP BY ALL"""
        ),
        "x6_concurrent": _logs("SELECT * EXCLUDE (id), true AS stopped_together FROM processed"),
        "k19_contract_report": _raw("SELECT row_number, position, error FROM listed", CONTRACT),
        "k18_anomaly_report": _logs("SELECT * FROM found"),
        "x1_stream_validate": _logs("SELECT row_id, CASE WHEN error_reason IS NULL THEN 'iot_processed_logs' ELSE 'iot_invalid_logs' END AS topic, CASE WHEN error_reason IS NULL THEN device_id END AS key, error_reason FROM checked"),
        "x2_stream_load": _logs("SELECT * REPLACE (row_number() OVER (ORDER BY id) AS id) FROM processed"),
        "x11_full_run": _full_run(),
        "x11_gated_run": _gated_run(),
    } | {"k8_features_parquet": _DEVICE_FEATURES, "a1_device_features": _DEVICE_FEATURES, "a1_device_features_seconds": _raw(_FEATURES_SQL, _NORMAL_SECONDS)}
