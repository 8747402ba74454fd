"""Object-store events: read either event shape, then describe and validate the object key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values.
EXTENSIONS = (".csv", ".json", ".jsonl", ".parquet")
LAYERS = ("raw", "processed", "curated", "anomalies")
MISSING_KEY = "Missing object key in event payload."
BAD_EXTENSION = "Unsupported file extension. Supported extensions: .csv, .json, .jsonl, .parquet."


def _text(document: Column, path: str) -> Column:
    return F.try_variant_get(document, path, "string")


def _first_given(document: Column, *names: str) -> Column:
    """First of several spellings with a non-empty value."""
    return F.coalesce(*[F.nullif(_text(document, f"$.{n}"), F.lit("")) for n in names])


def event_details(df: DataFrame, event: str = "event") -> DataFrame:
    """Add ``bucket``, ``object_key``, ``source_type``, ``event_name`` and ``record_count`` from the JSON text."""
    doc = F.col("_document")
    listed = F.try_variant_get(doc, "$.Records", "array<variant>")
    is_list = F.coalesce(F.size(listed) > 0, F.lit(False))
    readable = F.coalesce(F.ltrim(F.col(event)).startswith("{") & doc.isNotNull(), F.lit(False))
    kind = F.when(~readable, "unsupported_event").when(is_list, "s3_event").otherwise("direct_event")
    shape = F.col("source_type")
    s3, direct = shape == "s3_event", shape == "direct_event"
    coded = F.when(s3, F.nullif(_text(doc, "$.Records[0].s3.object.key"), F.lit(""))).when(
        direct, _first_given(doc, "key", "object_key", "s3_key")
    )
    parsed = df.withColumn("_document", F.try_parse_json(event)).withColumn("source_type", kind)
    return parsed.select(
        *df.columns,
        F.when(s3, _text(doc, "$.Records[0].s3.bucket.name")).when(direct, _first_given(doc, "bucket", "s3_bucket")).alias("bucket"),
        F.coalesce(F.try_url_decode(coded), F.replace(coded, F.lit("+"), F.lit(" "))).alias("object_key"),
        "source_type",
        F.when(s3, _text(doc, "$.Records[0].eventName")).alias("event_name"),
        F.when(s3, F.size(listed)).when(direct, 1).alias("record_count"),
    )


def key_details(df: DataFrame, key: str = "object_key") -> DataFrame:
    """Add ``file_extension``, ``filename``, ``key_directory`` and ``detected_layer``."""
    path = F.nullif(F.col(key), F.lit(""))
    filename = F.element_at(F.split(path, "/"), -1)
    # the directory keeps a lone leading slash, otherwise trailing slashes go
    head = F.regexp_extract(path, r"^(.*/)?[^/]*$", 1)
    directory = F.when(head.rlike("^/+$"), head).otherwise(F.rtrim(head, F.lit("/")))
    # leading dots of a file name do not start an extension
    extension = F.regexp_extract(F.lower(filename), r"^\.*[^.].*?(\.[^.]*)$", 1)
    parts = F.transform(F.split(path, "/"), lambda p: F.lower(F.trim(p)))
    return df.select(
        "*",
        extension.alias("file_extension"),
        filename.alias("filename"),
        directory.alias("key_directory"),
        F.get(F.filter(parts, lambda p: p.isin(*LAYERS)), F.lit(0)).alias("detected_layer"),
    )


def validate(df: DataFrame, key: str = "object_key") -> DataFrame:
    """Add ``validation_errors``, ``is_valid`` and ``status`` to a frame from ``key_details``."""
    absent = F.coalesce(F.col(key) == "", F.lit(True))
    problems = F.array_compact(
        F.array(
            F.when(absent, MISSING_KEY),
            F.when(~absent & ~F.col("file_extension").isin(*EXTENSIONS), BAD_EXTENSION),
        )
    )
    checked = df.withColumn("validation_errors", problems)
    return checked.withColumn("is_valid", F.size("validation_errors") == 0).withColumn(
        "status", F.when(F.col("is_valid"), "validated").otherwise("invalid")
    )


def branch(checked: DataFrame, fail_on_invalid: bool = False) -> DataFrame:
    """Continue with the valid objects, or stop when there is an invalid one."""
    if fail_on_invalid and not checked.filter(~F.col("is_valid")).isEmpty():
        raise ValueError("at least one object failed metadata validation")
    return checked.filter("is_valid")
