"""Timed-run documents: one JSON document per run, type-checked field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import payload
from ..operators.perf import PROFILES

STEP = "struct<name: string, command: array<string>, elapsed_seconds: double, return_code: bigint>"


def _plain(kind: str) -> str:
    """Type name without digits or element types; plain searches, because ``split`` compiles its pattern for every row."""
    return f"substring_index(substring_index({kind}, '(', 1), '<', 1)"


def _kind(path: str) -> str:
    """JSON type of a value in the document, DECIMAL without its digits; NULL when absent."""
    return _plain(f"schema_of_variant(variant_get(document, '{path}', 'variant'))")


def _is(path: str, *kinds: str) -> str:
    listed = ", ".join(f"'{k}'" for k in kinds)
    return f"coalesce({_kind(path)} IN ({listed}), false)"


# whole numbers may arrive as DECIMAL(n,0) when they are very large; those are refused as counts
_WHOLE, _NUMBER = ("BIGINT",), ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL")

# what has a field is an object; the type of a whole document, which names all its fields, is asked of the others only
_ROOT = f"(variant_get(document, '$.timestamp', 'variant') IS NOT NULL OR {_is('$', 'OBJECT')})"

# (passes, message) in the order the checks are made
HEAD_CHECKS = (
    (_is("$.timestamp", "STRING"), "timestamp must be a str."),
    (_is("$.profile", "STRING"), "profile must be a str."),
    (
        "try_variant_get(document, '$.profile', 'string') IN (" + ", ".join(f"'{p}'" for p in PROFILES) + ")",
        f"profile must be one of: {', '.join(PROFILES)}.",
    ),
    (_is("$.rows", *_WHOLE), "rows must be an integer."),
    (_is("$.consumer_messages", *_WHOLE), "consumer_messages must be an integer."),
    (_is("$.loader_messages", *_WHOLE), "loader_messages must be an integer."),
    (_is("$.dry_run", "BOOLEAN"), "dry_run must be a boolean."),
    (_is("$.total_elapsed_seconds", *_NUMBER), "total_elapsed_seconds must be numeric."),
    ("listed IS NOT NULL", "commands must be a list."),
)


def _step_problem(step: str) -> str:
    """First problem of one step (a VARIANT), NULL for a good one."""

    def kind(path: str) -> str:
        return _plain(f"schema_of_variant(try_variant_get({step}, '{path}', 'variant'))")

    parts = f"try_variant_get({step}, '$.command', 'array<variant>')"
    entry = f"(try_variant_get({step}, '$.name', 'variant') IS NOT NULL OR coalesce({kind('$')} = 'OBJECT', false))"
    return (
        f"CASE WHEN NOT {entry} THEN 'command entry must be a dict.' "
        f"WHEN NOT coalesce({kind('$.name')} = 'STRING', false) THEN 'command.name must be a str.' "
        f"WHEN {parts} IS NULL THEN 'command.command must be a list.' "
        f"WHEN NOT forall({parts}, p -> coalesce(schema_of_variant(p) = 'STRING', false)) THEN 'command.command must contain only strings.' "
        f"WHEN NOT coalesce({kind('$.elapsed_seconds')} IN ('BIGINT', 'DOUBLE', 'FLOAT', 'DECIMAL'), false) THEN 'command.elapsed_seconds must be numeric.' "
        f"WHEN {kind('$.return_code')} NOT IN ('BIGINT', 'VOID') THEN 'command.return_code must be an integer.' END"
    )


def documents(spark: SparkSession, path: str) -> DataFrame:
    """``file`` and ``content`` of every JSON file at a path."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    return files.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("value").alias("content"))


def parse(docs: DataFrame) -> DataFrame:
    """Typed run columns plus ``problem`` (NULL for a good document)."""
    head = " ".join(f"WHEN NOT coalesce({test}, false) THEN '{text}'" for test, text in HEAD_CHECKS)
    problem = (
        "CASE WHEN document IS NULL THEN 'not valid JSON' "
        f"WHEN NOT {_ROOT} THEN 'root JSON object must be a dict.' {head} "
        f"ELSE coalesce(get(filter(transform(steps, s -> {_step_problem('s')}), p -> p IS NOT NULL), 0), "
        "CASE WHEN size(steps) = 0 THEN 'commands must contain at least one step.' END) END"
    )
    read = docs.selectExpr("*", "try_parse_json(content) AS document").selectExpr(
        "*", "try_variant_get(document, '$.commands', 'array<variant>') AS listed"
    ).selectExpr("*", "coalesce(listed, array()) AS steps")
    checked = payload.once(read, f"{problem} AS problem")
    typed = {
        "timestamp": "string", "profile": "string", "rows": "bigint", "consumer_messages": "bigint",
        "loader_messages": "bigint", "dry_run": "boolean", "total_elapsed_seconds": "double", "commands": f"array<{STEP}>",
    }
    return checked.selectExpr(
        *[c for c in docs.columns if c != "content"],
        "problem",
        *[f"CASE WHEN problem IS NULL THEN try_variant_get(document, '$.{n}', '{t}') END AS {n}" for n, t in typed.items()],
    )


def runs(parsed: DataFrame, profile: str | None = None) -> DataFrame:
    good = parsed.filter("problem IS NULL").drop("problem")
    return good.filter(F.col("profile") == profile) if profile else good


def skipped(parsed: DataFrame) -> DataFrame:
    text: Column = F.concat(F.lit("Skipped malformed file "), "file", F.lit(": "), "problem")
    return parsed.filter("problem IS NOT NULL").select("file", text.alias("message"))
