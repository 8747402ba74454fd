"""Headline timings: prints one JSON line.

Every query is run in full and written to Spark's no-op sink, which computes all rows and columns
and moves none of them to the driver. A short run at a small scale first pays for starting the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from emberlog.operators import anomalies, contract, data_tests, mapping, marts, staging, validate  # noqa: E402
from emberlog.plans import bridge  # noqa: E402
from emberlog.plans.registry import REGISTRY  # noqa: E402
from emberlog.session import local_session, scratch_dir  # noqa: E402

HEADLINE = (
    "p2_raw_message", "f6_validate", "p4_map_processed", "q9_contract_job", "q6_anomalies", "a1_device_features",
    "a2_device_risk", "a3_attack_summary", "a4_protocol_metrics", "a5_quality_summary", "q10_not_null", "q13_checks",
    "s10_recent_rows", "r2_random_n", "a19_step_share", "a26_run_table", "f13_manifest_validity", "x1_stream_validate",
    "x2_stream_load", "x11_full_run",
)


def over_stored_tables(spark, sf_dir: str) -> dict[str, float]:
    """Jobs that start from warehouse tables, as they do in a running pipeline: writing those tables
    is not part of their time."""
    root = scratch_dir(spark, "bench")
    bridge.processed(spark, sf_dir).write.parquet(f"{root}/processed")
    bridge.logs(spark, sf_dir).repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{root}/logs")
    sent = validate.routed(bridge.messages(spark, sf_dir), bridge.AS_OF).filter(F.col("topic") == validate.PROCESSED_TOPIC)
    sent.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{root}/topic")
    rows, logs, topic = (spark.read.parquet(f"{root}/{name}") for name in ("processed", "logs", "topic"))
    staged = staging.stage_processed(rows)
    jobs = {
        "stored_contract": contract.run_contract(logs, contract.RAW_LOG_CONTRACT, F.col("row_id") + 1)[0],
        "stored_load": mapping.processed_rows(mapping.map_processed(topic), F.col("row_id"), bridge.AS_OF),
        "stored_anomalies": anomalies.detect(rows),
        "stored_anomaly_summary": anomalies.summary(rows),
        "stored_device_risk": marts.device_risk(staged),
        "stored_attack_summary": marts.attack_summary(staged),
        "stored_protocol_metrics": marts.protocol_metrics(staged),
        "stored_data_tests": data_tests.run_model(staged, "stg_processed_iot_logs", data_tests.STAGED_PROCESSED),
    }
    timings = {}
    for name, frame in jobs.items():
        start = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    return timings


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, shuffle_partitions=int(cores), memory=os.environ.get("BENCH_MEMORY", "12g"))
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in ("f6_validate", "a2_device_risk"):
            REGISTRY[name](spark, small).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    timings.update(over_stored_tables(spark, sf_dir))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
