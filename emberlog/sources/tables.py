"""Warehouse tables as Parquet folders, and guards around reading them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas

# Columns a quality run needs; None stands for all declared ones.
NEEDED: dict[str, set[str] | None] = {
    "processed_iot_logs": {"id"}, "invalid_iot_logs": {"id"}, "pipeline_run_audit": None, "pipeline_quality_checks": None, "pipeline_alerts": None,
}


def exists(spark: SparkSession, path: str) -> bool:
    """Does any file match? Asked of the file system the path belongs to."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def all_versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Everything ever written to a run table, with its ``version``; the table must have been written."""
    return spark.read.schema(f"{schemas.TABLES[name]}, version string").parquet(f"{root}/{name}")


def current(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The versions that count: run_id, version. Of each run the last replacing one and what was appended after it."""
    if not exists(spark, f"{root}/_versions"):
        return spark.createDataFrame([], "run_id string, version string")
    made = spark.read.schema(schemas.VERSIONS).parquet(f"{root}/_versions").filter(F.col("table_name") == name)
    floor = made.groupBy("run_id").agg(F.max(F.when(F.col("replaces"), F.col("version"))).alias("floor"))
    return made.join(floor, "run_id").filter("floor IS NULL OR version >= floor").select("run_id", "version").distinct()


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A warehouse table; empty while nothing was written."""
    if name in schemas.LOADED_TABLES:
        return read_loaded(spark, root, name)
    ddl = schemas.TABLES[name]
    if not exists(spark, f"{root}/{name}"):
        return spark.createDataFrame([], ddl)
    rows = all_versions(spark, root, name).join(current(spark, root, name), ["run_id", "version"], "left_semi")
    if name == "pipeline_alerts":
        rows = _with_published_flag(spark, root, rows)
    return rows.select(*schemas.column_names(ddl))


def _with_published_flag(spark: SparkSession, root: str, alerts: DataFrame) -> DataFrame:
    sent = read(spark, root, "pipeline_alert_publications").select("run_id", F.col("alerts_version").alias("version"), F.lit(True).alias("_sent")).distinct()
    return alerts.join(sent, ["run_id", "version"], "left").withColumn("is_published_to_kafka", F.coalesce("_sent", "is_published_to_kafka"))


def finished_loads(spark: SparkSession, root: str) -> DataFrame:
    """One row for each loaded batch: its last finished attempt (columns of LOADS)."""
    if not exists(spark, f"{root}/_loads"):
        return spark.createDataFrame([], schemas.LOADS)
    marks = spark.read.schema(schemas.LOADS).parquet(f"{root}/_loads")
    return marks.groupBy("batch_id").agg(F.max_by(F.struct(*marks.columns), "attempt").alias("m")).select("m.*")


def read_loaded(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Rows of finished loads: of each batch the attempt its last marker names."""
    ddl = schemas.TABLES[name]
    if not exists(spark, f"{root}/_batches"):
        return spark.createDataFrame([], ddl)
    rows = spark.read.schema(f"{schemas.LOADED}, batch_id bigint, attempt string, target string").parquet(f"{root}/_batches")
    seen = rows.filter(F.col("target") == name).join(finished_loads(spark, root).select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi")
    return seen.select(*schemas.column_names(ddl))


def newest_batch(spark: SparkSession, root: str) -> int:
    """Number of the last finished load, -1 before the first."""
    last = finished_loads(spark, root).agg(F.max("batch_id")).first()[0]
    return -1 if last is None else last


def last_ids(spark: SparkSession, root: str, before: int) -> list[int]:
    """The last ids of the loaded tables after batches below ``before``: a repeated batch gets its ids again."""
    names = ("last_processed_id", "last_invalid_id", "last_quarantine_id")
    row = finished_loads(spark, root).filter(F.col("batch_id") < before).agg(*[F.max(n).alias(n) for n in names]).first()
    return [row[n] or 0 for n in names]


def preview(df: DataFrame, limit: int | None = None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def missing_tables(spark: SparkSession, names: list[str]) -> list[str]:
    """Names that are not in the catalog, in the given order."""
    return [name for name in names if not spark.catalog.tableExists(name)]


def require_schema(tables: dict[str, DataFrame | None], needed: dict[str, set[str] | None] = NEEDED) -> None:
    """Every needed table is there with its needed columns."""
    for name, columns in needed.items():
        frame = tables.get(name)
        if frame is None:
            raise RuntimeError(f"required table '{name}' does not exist")
        absent = sorted((set(schemas.column_names(schemas.TABLES[name])) if columns is None else columns) - set(frame.columns))
        if absent:
            raise RuntimeError(f"table '{name}' is missing required columns: {', '.join(absent)}")


def load_frames(
    spark: SparkSession, names: list[str], missing: list[str] | None = None
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Frames by name, and what is wrong with the others, which become empty frames: ``missing`` for an absent table,
    else the kind of the error.

    The first row of every table is read here, so that a table whose files are gone or damaged is found now and
    not when a report is half done. ``missing`` names the absent tables where the caller already asked.
    """
    frames: dict[str, DataFrame] = {}
    errors: dict[str, str] = {}
    absent = set(missing_tables(spark, names) if missing is None else missing)
    for name in names:
        try:
            if name in absent:
                raise LookupError(name)
            frames[name] = spark.table(name)
            frames[name].limit(1).collect()
        except Exception as error:  # noqa: BLE001 - any read failure leaves the table out
            frames[name] = spark.createDataFrame([], "dummy int").drop("dummy")
            errors[name] = "missing" if name in absent else type(error).__name__
    return frames, errors


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and size of every Parquet file below a folder; a missing or empty folder is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(f"features path does not exist: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isFile():
        raise NotADirectoryError(f"features path is not a directory: {path}")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    files = reader.load(path).select("path", "length")
    if files.isEmpty():
        raise FileNotFoundError(f"No .parquet files found under: {path}")
    return files
