"""File outputs: feature datasets, their publication under a prefix, CSV subsets and JSON reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import clock
from ..sources import tables


def write_features(features: DataFrame, path: str) -> None:
    features.write.mode("overwrite").parquet(path)


def publish(df: DataFrame, bucket: str, prefix: str) -> DataFrame:
    """Write a dataset below ``bucket/prefix`` (any Hadoop file system) and list its object keys."""
    clean = prefix.strip("/")
    target = f"{bucket.rstrip('/')}/{clean}"
    df.write.mode("overwrite").parquet(target)
    files = tables.parquet_files(df.sparkSession, target)
    return files.select(F.concat(F.lit(f"{clean}/"), F.element_at(F.split("path", f"/{clean}/"), -1)).alias("object_key"), "length")


def write_subset(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """CSV with a header; an existing output is kept unless asked, and the input is never replaced."""
    def bare(place: str) -> str:
        return place.split(":", 1)[-1].strip("/") + "/"

    inside = [f for f in df.inputFiles() if bare(f).startswith(bare(path))]
    if inside:
        raise ValueError("input and output paths must be different")
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    writer.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_anomaly_report(
    summary: DataFrame, found: DataFrame, path: str, run_id: str, limit: int | None, mode: str, generated_at: Column | str
) -> None:
    """``path/summary`` holds the one report object, ``path/anomalies`` one JSON line per finding, so
    the findings are never gathered into one value."""
    head = summary.select(
        F.date_format(clock.moment(generated_at), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"),
        F.lit(run_id).alias("run_id"), F.lit(mode).alias("mode"), F.lit(limit).cast("bigint").alias("limit"),
        F.struct(*summary.columns).alias("summary"),
    )
    head.write.mode("overwrite").json(f"{path}/summary")
    found.write.mode("overwrite").json(f"{path}/anomalies")


def write_contract_report(
    summary: DataFrame, errors: DataFrame, path: str, input_path: str, contract_path: str, now: Column | str
) -> None:
    """``path/summary`` holds the one report object, ``path/errors`` one JSON line per error."""
    report = summary.select(
        F.lit(input_path).alias("input_path"), F.lit(contract_path).alias("contract_path"),
        "rows_checked", "valid_rows", "invalid_rows", "error_count",
        F.date_format(clock.moment(now), "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("timestamp"),
    )
    report.write.mode("overwrite").json(f"{path}/summary")
    errors.select("row_number", "position", "error").write.mode("overwrite").json(f"{path}/errors")
