"""Log files: strict and lenient CSV scans."""

from __future__ import annotations

from collections.abc import Iterator
from csv import reader as parse_csv
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import clock
from ..functions.ordering import first_rows, number_rows
from ..functions.text import strip
from ..operators.features import require_columns
from ..operators.sampling import clean_header

# Fixed values.
COLUMNS = (
    "event_timestamp", "device_id", "source_ip", "destination_ip", "protocol",
    "packet_size", "duration_ms", "event_type", "attack_type", "status",
)
PROFILE_PATHS = {
    "sample": "data/samples/sample_iot_logs.csv",
    "medium": "data/processed/medium_iot_logs.csv",
    "full": "data/raw/full_iot_logs.csv",
}
_BROKEN = "_broken_row"
_ABSENT = "\x00absent\x00"


def input_path(profile: str = "sample", explicit: str | None = None, paths: dict[str, str] = PROFILE_PATHS) -> str:
    """Path of a dataset profile; an explicit path wins."""
    if explicit:
        return explicit
    name = profile.strip().lower() or "sample"
    if name not in paths:
        raise ValueError(f"dataset profile {profile!r} is invalid; allowed values are {', '.join(paths)}")
    return paths[name]


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line of a task's file that is not blank; the rest of the file is not read."""
    for batch in batches:
        for at, line in enumerate(batch.column("value").to_pylist()):
            if line.strip():
                yield pa.RecordBatch.from_pydict({"value": [line.lstrip("\ufeff")], "file": [batch.column("file")[at].as_py()]})
                return


def _first_lines(spark: SparkSession, path: str) -> list[tuple[str, str | None]]:
    """(first line, file) of the files of a scan: one row for all if their first lines are equal, else one for each.

    Every file is one task, which stops after its first line. The driver opens no file.
    """
    # a split is as large as the largest file can be, and opening one costs as much, so no task gets two files
    whole = {"spark.sql.files.maxPartitionBytes": str(2**50), "spark.sql.files.openCostInBytes": str(2**50)}
    before = {name: spark.conf.get(name, None) for name in whole}
    try:
        for name, value in whole.items():
            spark.conf.set(name, value)
        lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).mapInArrow(_first_line, "value string, file string")
        kinds = lines.select("value").distinct().limit(2).collect()
        return [(r["value"], None) for r in kinds] if len(kinds) < 2 else [tuple(r) for r in lines.collect()]
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a scan by their own cleaned header; empty files are left out. If all files have one header, the
    path stands for them."""
    found: dict[tuple[str, ...], list[str]] = {}
    for line, file in _first_lines(spark, path):
        found.setdefault(tuple(clean_header(n) for n in next(parse_csv([line]))), []).append(file or path)
    return found


def _by_header(spark: SparkSession, path: str, required: tuple[str, ...], read) -> DataFrame:
    """``read(names, files)`` for every header of a scan, together; columns are matched by name."""
    groups = headers(spark, path)
    if not groups:
        raise ValueError(f"no header in {path}")
    for names in groups:
        _require(names, required)
    parts = [read(names, files) for names, files in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _require(names, required=COLUMNS) -> None:
    for name in required:
        if name not in names:
            raise ValueError(f'missing required csv column "{name}"')


def _text_schema(names) -> str:
    return ", ".join(f"`{n}` string" for n in names)


def scan_strict(spark: SparkSession, path: str, required=None) -> DataFrame:
    """Text columns; one malformed row stops the job. Every file is read by its own header.

    With column pruning the parser would not look at the whole row and would miss ragged ones, so
    it is off for this scan.
    """
    def read(names, files):
        reader = spark.read.schema(_text_schema(names)).option("columnPruning", "false")
        return reader.csv(files, header=True, mode="FAILFAST", enforceSchema=True)

    df = _by_header(spark, path, (), read)
    return require_columns(df, required) if required else require_columns(df)


def scan_lenient(spark: SparkSession, path: str, multiline: bool = False) -> tuple[DataFrame, Observation]:
    """Accepted rows, and an observation of the one scan that has ``skipped_rows`` once they are written.

    Like every observation it counts per scan: a global sort, which scans twice, counts twice.

    Text is trimmed. Rows with fewer fields than their file's header and rows whose sizes are not
    integers are skipped; extra trailing fields are ignored. Accepted rows keep ``_file``, ``_block``
    and ``_seq`` (see ``number_rows``).
    """
    number = {n: F.expr(f"try_cast({strip(f'`{n}`')} AS int)") for n in ("packet_size", "duration_ms")}

    def read(names, files):
        # without column pruning, so that a count of skipped rows still sees which rows are ragged
        scanned = spark.read.option("columnPruning", "false").csv(
            files, schema=f"{_text_schema(names)}, `{_BROKEN}` string", header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN,
            multiLine=multiline, enforceSchema=True, nullValue=_ABSENT, emptyValue="",
        )
        # a short row is broken and lacks its last declared field; a long one is broken but complete
        short = F.col(_BROKEN).isNotNull() & F.col(f"`{names[-1]}`").isNull()
        fits = F.coalesce(~short, F.lit(True)) & number["packet_size"].isNotNull() & number["duration_ms"].isNotNull()
        return scanned.select(
            *[number[n].alias(n) if n in number else F.expr(f"coalesce({strip(f'`{n}`')}, '')").alias(n) for n in COLUMNS],
            fits.alias("_fits"), *_place(),
        )

    seen = Observation()
    shaped = _by_header(spark, path, COLUMNS, read).observe(seen, F.count_if(~F.col("_fits")).alias("skipped_rows"))
    return shaped.filter("_fits").drop("_fits"), seen


def _place() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    ]


def scan_places(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """All header columns as text with the place of each row: input of ``contract.run_on_files``."""
    def read(names, files):
        scanned = spark.read.csv(files, schema=_text_schema(names), header=True, mode="PERMISSIVE", multiLine=multiline, enforceSchema=True)
        return scanned.select("*", *_place())

    return _by_header(spark, path, (), read)


def scan_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """``scan_places`` with ``row_number`` per file (data starts at 2)."""
    return number_rows(scan_places(spark, path, multiline), first=2)


def cap_rows(accepted: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` accepted rows in file order (files in any fixed order); 0 means all."""
    if max_rows <= 0:
        return accepted
    return first_rows(accepted, [F.xxhash64("_file"), F.col("_block"), F.col("_seq")], max_rows)


def messages(accepted: DataFrame, now: Column | str) -> DataFrame:
    """Raw-topic messages: key is the device, value the JSON text with the ingestion time."""
    stamped = accepted.withColumn("_now", clock.moment(now))
    keys = [c for c in accepted.columns if c not in COLUMNS and not c.startswith("_")]
    body = f"struct({', '.join(COLUMNS)}, {clock.iso_seconds('_now')} AS ingestion_timestamp)"
    return stamped.selectExpr(*keys, "device_id AS key", f"to_json({body}) AS value")
