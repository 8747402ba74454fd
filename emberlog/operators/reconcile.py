"""Run acceptance: load deltas, dataset preflight, and the roll-up of named check results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

STATUSES = ("passed", "failed", "skipped", "dry_run")

# Reported stage name and the check result it is read from, first present one wins.
STAGES = (
    ("data_contract_validation", ("data_contract_validation",)),
    ("producer", ("profile_pipeline_producer",)),
    ("consumer", ("profile_pipeline_consumer",)),
    ("warehouse_loader", ("profile_pipeline_warehouse_loader",)),
    ("anomaly_detection", ("profile_pipeline_anomaly_detection_read_only",)),
    (
        "postgresql_verification",
        ("profile_pipeline_verify_postgres_deltas", "profile_pipeline_post_run_postgres_counts"),
    ),
)
SHORT_STAGES = (STAGES[0], ("anomaly_detection", ("anomaly_detection_read_only",)))


def table_counts(processed: DataFrame, invalid: DataFrame) -> DataFrame:
    """Row counts of both tables in one row."""
    one = F.count(F.lit(1))
    return processed.agg(one.alias("processed_count")).crossJoin(F.broadcast(invalid.agg(one.alias("invalid_count"))))


def load_delta(before: DataFrame, after: DataFrame, expected_rows: int | DataFrame) -> DataFrame:
    """What a load added, and whether it is exactly the expected number of rows.

    ``before`` and ``after`` are one-row counts; ``expected_rows`` is a number or a one-row frame
    with an ``expected_rows`` column.
    """
    first = before.select(F.col("processed_count").alias("p0"), F.col("invalid_count").alias("i0"))
    both = after.crossJoin(F.broadcast(first))
    if isinstance(expected_rows, DataFrame):
        both = both.crossJoin(F.broadcast(expected_rows.select("expected_rows")))
    else:
        both = both.withColumn("expected_rows", F.lit(expected_rows).cast("bigint"))
    deltas = both.select(
        (F.col("processed_count") - F.col("p0")).alias("processed_delta"),
        (F.col("invalid_count") - F.col("i0")).alias("invalid_delta"),
        "expected_rows",
    ).withColumn("total_delta", F.col("processed_delta") + F.col("invalid_delta"))
    accepted = (
        (F.col("total_delta") == F.col("expected_rows")) & (F.col("processed_delta") >= 0) & (F.col("invalid_delta") >= 0)
    )
    return deltas.withColumn("status", F.when(accepted, "passed").otherwise("failed"))


def bounded_count(df: DataFrame, most: int) -> DataFrame:
    """Row count that does not go beyond ``most``."""
    return df.agg(F.least(F.count(F.lit(1)), F.lit(most)).alias("row_count"))


def preflight(df: DataFrame, profile: str, max_rows: int) -> DataFrame:
    """Available rows against the requested cap; only the full profile must have enough."""
    short = (F.lit(profile) == "full") & (F.col("available_rows") < max_rows)
    return df.agg(F.count(F.lit(1)).alias("available_rows")).select(
        F.lit(profile).alias("profile"),
        "available_rows",
        F.least("available_rows", F.lit(max_rows)).alias("bounded_rows"),
        F.when(short, "failed").otherwise("passed").alias("status"),
    )


def status_rollup(results: DataFrame) -> DataFrame:
    """Counts per status with zeros, overall status, and the sorted names of required failures.

    The four usual statuses have a column each; ``other_statuses`` counts all rows with any other one.
    """
    failure = F.col("required") & (F.col("status") == "failed")
    return results.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        F.count_if(F.col("status").isNull() | ~F.col("status").isin(*STATUSES)).alias("other_statuses"),
        F.when(F.coalesce(F.bool_or(failure), F.lit(False)), "failed").otherwise("passed").alias("overall_status"),
        # a set of check names, not of rows: bounded by the number of distinct checks
        F.array_join(F.array_sort(F.collect_set(F.when(failure, F.col("name")))), ", ").alias("required_failures"),
    )


def stage_durations(results: DataFrame, full_run: bool = True) -> DataFrame:
    """Seconds per reported stage; stages without a duration are left out, the last result of a name counts."""
    stages = STAGES if full_run else SHORT_STAGES
    wanted = [name for _, names in stages for name in names]
    timed = results.filter((F.col("duration_seconds") != 0) & F.col("name").isin(*wanted))
    latest = timed.groupBy().agg(
        *[F.max_by(F.when(F.col("name") == n, F.col("duration_seconds")), F.when(F.col("name") == n, F.col("position"))).alias(n) for n in wanted]
    )
    cells = [F.struct(F.lit(stage).alias("stage"), F.coalesce(*names).alias("duration_seconds")) for stage, names in stages]
    return latest.select(F.inline(F.array(*cells))).filter(F.col("duration_seconds").isNotNull())
