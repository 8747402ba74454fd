"""Update semantics on run tables as frame transformations (plain Parquet has no MERGE)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KEPT_ON_UPDATE = ("id", "created_at")


def keep_first(df: DataFrame, key: str = "run_id", order: str = "id") -> DataFrame:
    """The row with the smallest ``order`` per key, as an aggregate: a key with very many copies is
    reduced inside each task before it is shuffled, which a window could not do."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(key).agg(F.min_by(row, order).alias("row")).select("row.*")


def upsert(existing: DataFrame, incoming: DataFrame, next_id: Column, now: Column) -> DataFrame:
    """Table after upserting ``incoming`` (one row per run_id).

    A run already stored keeps its smallest id and that row's creation time, its other copies go;
    a new run gets ``next_id`` and ``now``. Runs that are not in ``incoming`` stay as they are.
    """
    columns = existing.columns
    untouched = existing.join(incoming.select("run_id"), "run_id", "left_anti").select(*columns)
    stored = existing.join(incoming.select("run_id"), "run_id", "left_semi")
    kept = stored.groupBy("run_id").agg(
        F.min("id").alias("_id"), F.min_by("created_at", "id").alias("_created_at")
    )
    merged = incoming.join(kept, "run_id", "left").select(
        F.coalesce("_id", next_id).alias("id"),
        *[F.col(c) for c in columns if c not in KEPT_ON_UPDATE],
        F.coalesce("_created_at", now).alias("created_at"),
    )
    return untouched.unionByName(merged.select(*columns))


def replace_runs(existing: DataFrame, incoming: DataFrame, run_ids: DataFrame) -> DataFrame:
    """Table after replacing every row of ``run_ids``; runs with no incoming rows end up empty."""
    return existing.join(run_ids.select("run_id").distinct(), "run_id", "left_anti").select(
        *existing.columns
    ).unionByName(incoming.select(*existing.columns))


def set_published(alerts: DataFrame, run_id: Column) -> DataFrame:
    flag = F.when(F.col("run_id") == run_id, True).otherwise(F.col("is_published_to_kafka"))
    return alerts.withColumn("is_published_to_kafka", flag)


def recent_runs(audit: DataFrame, limit: int = 20) -> DataFrame:
    return audit.orderBy(F.col("created_at").desc(), F.col("finished_at").desc_nulls_last(), F.col("run_id").desc()).limit(limit)


def recent_rows(df: DataFrame, limit: int) -> DataFrame:
    """Newest checks (100) or alerts (50)."""
    return df.orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(limit)


def latest_run(audit: DataFrame) -> DataFrame:
    return recent_runs(audit, 1)


def of_latest_run(checks: DataFrame, audit: DataFrame) -> DataFrame:
    # at most one row on the joined side
    return checks.join(F.broadcast(latest_run(audit).select("run_id")), "run_id", "left_semi")


def rows_of_latest(rows: DataFrame, audit: DataFrame) -> DataFrame:
    """Rows (run_id) of the run that was audited last. The newest creation time is a filter on the audit rows, so Spark
    prunes the partitions of a table kept by run_id before it reads them."""
    newest = audit.agg(F.max("created_at"))
    latest = audit.filter(F.col("created_at") == newest.scalar()).agg(F.max("run_id").alias("run_id"))
    return rows.join(latest, "run_id", "left_semi")


def with_run_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return df.filter(F.col("run_id").startswith(prefix))


def committed_offsets(consumed: DataFrame) -> DataFrame:
    """Next offset to read per topic and partition."""
    return consumed.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
