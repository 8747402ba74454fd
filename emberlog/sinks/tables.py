"""Writing warehouse tables so that readers never see half a write.

Every write goes to folders of its own (an attempt of a batch, a version of a run) and counts only once a row that
names it has been added afterwards. A write that fails leaves folders nobody reads; a write that is repeated adds an
attempt or version that takes over in one step. Rows are never overwritten in place.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from .. import schemas
from ..functions import clock
from ..sources import tables


def new_version() -> str:
    """A name that sorts by the time it was made."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


# --- batches of the loader --------------------------------------------------------------------

def write_attempt(rows: DataFrame, root: str, batch_id: int, size: int) -> dict[str, int]:
    """Write a batch in one pass, then make this attempt the batch's visible one; returns the rows by table.

    ``rows`` have the columns of LOADED and ``target``, with ``id`` numbered from 1 to ``size``; each table counts on
    from its own last id.
    """
    spark, attempt, seen = rows.sparkSession, new_version(), Observation()
    names = schemas.LOADED_TABLES
    last = tables.last_ids(spark, root, batch_id)
    base = F.element_at(F.array(*map(F.lit, last)), F.array_position(F.array(*map(F.lit, names)), F.col("target")).cast("int"))
    counts = [F.count_if(F.col("target") == name).alias(name) for name in names]
    placed = rows.withColumn("id", (F.col("id") + base).cast("bigint")).select(*schemas.column_names(schemas.LOADED), "target")
    placed.observe(seen, *counts).write.partitionBy("target").parquet(f"{root}/_batches/batch_id={batch_id}/attempt={attempt}")
    n = [int(seen.get[name] or 0) for name in names]
    marker = (batch_id, attempt, *n, *[at + size if rows_there else at for at, rows_there in zip(last, n, strict=True)])
    spark.createDataFrame([marker], schemas.LOADS).coalesce(1).write.mode("append").parquet(f"{root}/_loads")
    return dict(zip(names, n, strict=True))


def truncate(spark: SparkSession, root: str) -> None:
    """Empty the loaded tables before a run; ids start again.

    The markers go first, so a crash in between leaves empty tables and unread folders. Quarantined messages belong
    to the loads and go with them.
    """
    for name, ddl in (("_loads", schemas.LOADS), ("_batches", schemas.LOADED)):
        spark.createDataFrame([], ddl).write.mode("overwrite").parquet(f"{root}/{name}")


# --- run tables -------------------------------------------------------------------------------

def _write_version(df: DataFrame, root: str, name: str) -> str:
    version = new_version()
    df.select(*schemas.column_names(schemas.TABLES[name])).withColumn("version", F.lit(version)).write.mode("append").partitionBy(
        "version", "run_id"
    ).parquet(f"{root}/{name}")
    return version


def _make_visible(run_ids: DataFrame, root: str, name: str, version: str, replaces: bool) -> None:
    rows = run_ids.select(F.lit(name).alias("table_name"), "run_id", F.lit(version).alias("version"), F.lit(replaces).alias("replaces"))
    rows.write.mode("append").parquet(f"{root}/_versions")


def _run(spark: SparkSession, run_id: str) -> DataFrame:
    return spark.range(1, numPartitions=1).select(F.lit(run_id).alias("run_id"))


def append_run(df: DataFrame, root: str, name: str) -> None:
    """Append rows that carry their run_id; rows the runs have already stay."""
    spark = df.sparkSession
    version = _write_version(df, root, name)
    if tables.exists(spark, f"{root}/{name}"):  # a frame without rows writes no folder
        written = tables.all_versions(spark, root, name).filter(F.col("version") == version).select("run_id").distinct()
        _make_visible(written, root, name, version, replaces=False)


def replace_runs(df: DataFrame, root: str, name: str, run_ids: DataFrame) -> None:
    """Replace all rows of ``run_ids`` by those of ``df``; a run without new rows ends up without rows."""
    _make_visible(run_ids.select("run_id").distinct(), root, name, _write_version(df, root, name), replaces=True)


def replace_run(df: DataFrame, root: str, name: str, run_id: str) -> None:
    replace_runs(df, root, name, _run(df.sparkSession, run_id))


def _next_id(stored: DataFrame) -> int:
    return (stored.agg(F.max("id")).first()[0] or 0) + 1


def upsert_audit(row: DataFrame, root: str, run_id: str, now: Column | str) -> None:
    """Insert or update the audit row of a run. A stored run keeps its smallest id and the creation
    time that goes with it; one aggregate over the table brings those values to the driver."""
    stored = tables.read(row.sparkSession, root, "pipeline_run_audit")
    own = F.col("run_id") == run_id
    known = stored.agg(
        F.max("id").alias("last"), F.min(F.when(own, F.col("id"))).alias("id"), F.min_by("created_at", F.when(own, F.col("id"))).alias("at")
    ).first()
    new_id = known["id"] if known["id"] is not None else (known["last"] or 0) + 1
    created = F.lit(known["at"]) if known["id"] is not None else clock.moment(now)
    replace_run(row.withColumns({"id": F.lit(new_id).cast("bigint"), "created_at": created}), root, "pipeline_run_audit", run_id)


def replace_numbered(df: DataFrame, root: str, name: str, run_id: str, order: str) -> None:
    """``replace_run`` for check and alert rows (a handful per run), numbered after the stored ids."""
    base = _next_id(tables.read(df.sparkSession, root, name).filter(F.col("run_id") != run_id))
    # one run has one row per check, so the single window partition is that small
    place = F.rank().over(Window.partitionBy("run_id").orderBy(order)) - 1
    replace_run(df.withColumn("id", (F.lit(base) + place).cast("bigint")), root, name, run_id)


def replace_alerts(df: DataFrame, root: str, run_id: str) -> None:
    """``replace_numbered`` for alerts. New alerts are not published: a publication names the version it sent."""
    replace_numbered(df, root, "pipeline_alerts", run_id, "alert_type")


def mark_published(spark: SparkSession, root: str, run_id: str, now: Column | str) -> None:
    """Set the published flag on the alerts a run has now: rows in a table of its own, which readers
    join. No alert row is read or written again."""
    now_visible = tables.current(spark, root, "pipeline_alerts").filter(F.col("run_id") == run_id)
    rows = now_visible.select(F.col("version").alias("alerts_version"), clock.moment(now).alias("published_at"), "run_id")
    append_run(rows, root, "pipeline_alert_publications")


# --- ids --------------------------------------------------------------------------------------

def _numbered(df: DataFrame, draft: str, first: int) -> tuple[DataFrame, int]:
    """Rows of ``df`` with a 64-bit ``id`` from ``first`` on, and how many there are.

    An id needs the number of rows of all tasks before, so the rows are stored once without ids and counted by file;
    one number for each task comes to the driver.
    """
    spark = df.sparkSession
    df.write.parquet(draft)
    rows = spark.read.schema(df.schema).parquet(draft).select(
        "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    starts, following = [], first
    for file, n in rows.groupBy("_file").count().orderBy("_file").collect():
        starts.append((file, following))
        following += n
    # one row per file of the draft
    blocks = F.broadcast(spark.createDataFrame(starts, "_file string, _start bigint"))
    numbered = rows.join(blocks, "_file").withColumn("id", F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")
    return numbered, following - first


def append_numbered(df: DataFrame, root: str, name: str) -> int:
    """``append_run`` with ids after the stored ones; returns the rows written."""
    numbered, n = _numbered(df, f"{root}/_drafts/{name}-{new_version()}", _next_id(tables.read(df.sparkSession, root, name)))
    append_run(numbered, root, name)
    return n


# --- catalog ----------------------------------------------------------------------------------

def create_if_missing(spark: SparkSession, table: str, name: str) -> None:
    """Catalog table with the declared schema, partitioned by run where it has runs."""
    ddl = schemas.TABLES[name]
    clause = "PARTITIONED BY (run_id)" if "run_id" in schemas.column_names(ddl) else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet {clause}")


def insert(df: DataFrame, table: str, name: str, drafts: str) -> None:
    """Append rows with the declared columns to a catalog table; each run goes to its partition. Rows without ids
    are numbered after the stored ones (``drafts``: a folder for the rows meanwhile)."""
    rows = df if "id" in df.columns else _numbered(df, f"{drafts}/{name}-{new_version()}", _next_id(df.sparkSession.table(table)))[0]
    rows.select(*df.sparkSession.table(table).columns).write.mode("append").insertInto(table)


def materialize(models: dict[str, DataFrame], prefix: str = "") -> None:
    """Write models as catalog tables, rebuilt each time."""
    for name, df in models.items():
        df.write.mode("overwrite").saveAsTable(f"{prefix}{name}")
