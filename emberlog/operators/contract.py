"""Data contract: per-column rules given as data, compiled to column expressions."""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.ordering import number_rows, top_rows
from ..functions.payload import once
from ..functions.text import is_blank, quote, quote_list, strip


class ContractError(ValueError):
    """The contract or the call is unusable (not: the data is bad)."""


@dataclass(frozen=True)
class Rule:
    required: bool = False
    nullable: bool = True
    kind: str = "string"
    min_length: int | None = None
    minimum: int | float | None = None
    allowed: tuple[str, ...] = ()


_TEXT = Rule(required=True, nullable=False, min_length=1)
_COUNT = Rule(required=True, nullable=False, kind="integer", minimum=0)

# The raw-log contract, in report order.
RAW_LOG_CONTRACT: dict[str, Rule] = {
    "event_timestamp": Rule(required=True, nullable=False, kind="datetime", min_length=1),
    "device_id": _TEXT,
    "source_ip": Rule(required=True, nullable=False, kind="ip_address", min_length=1),
    "destination_ip": Rule(required=True, nullable=False, kind="ip_address", min_length=1),
    "protocol": Rule(True, False, min_length=1, allowed=("TCP", "UDP", "ICMP", "HTTP", "HTTPS", "MQTT", "ARP")),
    "packet_size": _COUNT,
    "duration_ms": _COUNT,
    "event_type": _TEXT,
    "attack_type": Rule(required=True, nullable=True),
    "status": Rule(True, False, min_length=1, allowed=("success", "failed", "blocked", "allowed", "warning")),
}
NUMBER_KINDS = ("number", "float", "decimal")


def load_contract(path: str) -> dict[str, Rule]:
    """Read a contract document (JSON, or YAML where a YAML reader is installed)."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        document = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as missing:
            raise ContractError("reading a YAML contract needs a YAML package; use JSON") from missing
        document = yaml.safe_load(text)
    columns = (document.get("schema") or {}).get("columns")
    if not isinstance(columns, dict) or not columns:
        raise ContractError("contract defines no schema.columns")
    return {name: _rule(spec or {}) for name, spec in columns.items()}


def _rule(spec: dict) -> Rule:
    checks = spec.get("validation") or {}
    kinds = {str(spec.get("logical_type", "")).lower(), str(spec.get("storage_type", "")).lower()}
    kind = "integer" if "integer" in kinds else next((k for k in NUMBER_KINDS if k in kinds), "string")
    return Rule(
        required=bool(spec.get("required", False)),
        nullable=bool(spec.get("nullable", True)),
        kind=kind,
        min_length=checks.get("min_length"),
        minimum=checks.get("min"),
        allowed=tuple(str(v) for v in checks.get("allowed_values") or ()),
    )


def column_errors(name: str, rule: Rule) -> list[str]:
    """SQL of the nullable error texts of one column, in report order, without the row they belong to."""
    value = strip(f"cast(`{name}` AS string)")
    empty = f"(`{name}` IS NULL OR {is_blank(f'cast(`{name}` AS string)')})"

    def error(test: str, *tail: str) -> str:
        words = ", ".join([quote(f": column '{name}' ")] + list(tail))
        return f"CASE WHEN {test} THEN concat({words}) END"

    found: list[str] = []
    if rule.required and not rule.nullable:
        found.append(error(empty, quote("is required and cannot be empty.")))
    if rule.min_length is not None and rule.min_length > 1:
        # a value that is not empty has at least one character, so shorter limits never fire
        found.append(
            error(f"NOT {empty} AND char_length({value}) < {rule.min_length}", quote(f"must be at least {rule.min_length} characters long."))
        )
    usable = f"NOT {empty}"
    if rule.kind == "integer" or rule.kind in NUMBER_KINDS:
        kind, wanted = ("bigint", "an integer") if rule.kind == "integer" else ("double", "a number")
        number = f"try_cast({value} AS {kind})"
        found.append(error(f"{usable} AND {number} IS NULL", quote(f"expects {wanted} but got '"), value, quote("'")))
        usable = f"{usable} AND {number} IS NOT NULL"
        if rule.minimum is not None:
            found.append(error(f"{number} < {rule.minimum}", quote(f"must be >= {rule.minimum}, got "), value, quote(".")))
    if rule.allowed:
        folded = quote_list(sorted({v.strip().lower() for v in rule.allowed}))
        listed = quote(f"' outside allowed values [{', '.join(rule.allowed)}].")
        found.append(error(f"{usable} AND lower({value}) NOT IN ({folded})", quote("has value '"), value, listed))
    return found


def missing_columns(df: DataFrame, contract: dict[str, Rule]) -> list[str]:
    return [name for name, rule in contract.items() if rule.required and name not in df.columns]


def _faults(df: DataFrame, contract: dict[str, Rule], *keys: str) -> DataFrame:
    """``keys`` and ``faults``: the error texts of each row without its number."""
    present = {n: r for n, r in contract.items() if n in df.columns}
    errors = ", ".join(e for name, rule in present.items() for e in column_errors(name, rule))
    # built once per row: filters on the errors stay above the generator
    return once(df.select(*keys, *present), f"array_compact(array({errors})) AS faults").select(*keys, "faults")


_NAMED = "transform(faults, f -> concat('Row ', row_number, f)) AS errors"


def check_rows(df: DataFrame, contract: dict[str, Rule], row_number: Column) -> DataFrame:
    """``row_number`` and ``errors`` (array, empty for a good row) per row. Data starts at row 2."""
    numbered = df.withColumn("row_number", row_number.cast("bigint"))
    return _faults(numbered, contract, "row_number").selectExpr("row_number", _NAMED)


def run_on_files(scanned: DataFrame, contract: dict[str, Rule]) -> tuple[DataFrame, DataFrame]:
    """``run_contract`` over files (``csv.scan_places``): (summary, errors with ``file``).

    Rows are checked as they are scanned and never shuffled; a row's number needs the rows of the splits before it,
    so only rows with errors are joined with the starts of the splits.
    """
    if missing_columns(scanned, contract):
        summary, errors = run_contract(scanned, contract, F.lit(None))
        return summary, errors.select(F.lit(None).cast("string").alias("file"), "*")
    checked = _faults(scanned, contract, "_file", "_block", "_seq")
    bad = number_rows(checked.filter("size(faults) > 0"), first=2, scanned=scanned)
    listed = bad.selectExpr("_file AS file", "row_number", _NAMED).select("file", "row_number", F.posexplode("errors").alias("position", "error"))
    return totals(checked.select(F.col("faults").alias("errors"))).withColumn("stopped_early", F.lit(False)), listed


def error_list(checked: DataFrame) -> DataFrame:
    """One row per error, with its place inside the row."""
    return checked.select("row_number", F.posexplode("errors").alias("position", "error"))


def totals(checked: DataFrame) -> DataFrame:
    """Row and error counts without an error cap."""
    n = F.size("errors")
    return checked.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(n == 0).alias("valid_rows"),
        F.count_if(n > 0).alias("invalid_rows"),
        F.coalesce(F.sum(n), F.lit(0)).alias("error_count"),
    )


def _leading_errors(checked: DataFrame, max_errors: int) -> DataFrame:
    """The first rows with errors, enough to pass the cap, with a running error total.

    Every such row has at least one error, so ``max_errors + 1`` of them suffice: the running sum
    is over that many rows, however large the input is. The cap is meant for a report people read;
    for all errors use ``error_list``, which has no order to keep and no cap.
    """
    if max_errors <= 0:
        raise ContractError("max_errors must be a positive integer")
    bad = checked.filter(F.size("errors") > 0)
    leading = top_rows(bad, [F.col("row_number")], max_errors + 1)
    order = Window.orderBy("row_number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return leading.withColumn("reached", F.sum(F.size("errors")).over(order))


def capped_errors(checked: DataFrame, max_errors: int) -> DataFrame:
    """The first ``max_errors`` errors in row order."""
    listed = _leading_errors(checked, max_errors).select(
        "row_number", (F.col("reached") - F.size("errors")).alias("before"), F.posexplode("errors").alias("position", "error")
    )
    return listed.filter(F.col("before") + F.col("position") < max_errors).select("row_number", "position", "error")


def capped_totals(checked: DataFrame, max_errors: int) -> DataFrame:
    """Counts up to and including the row whose errors pass the cap; ``stopped_early`` tells."""
    stop = _leading_errors(checked, max_errors).agg(
        F.min(F.when(F.col("reached") > max_errors, F.col("row_number"))).alias("stop_row")
    )
    # one row by construction
    seen = checked.crossJoin(F.broadcast(stop)).filter(
        F.col("stop_row").isNull() | (F.col("row_number") <= F.col("stop_row"))
    )
    n = F.size("errors")
    return seen.agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(n == 0).alias("valid_rows"),
        F.count_if(n > 0).alias("invalid_rows"),
        F.least(F.coalesce(F.sum(n), F.lit(0)), F.lit(max_errors)).alias("error_count"),
        F.coalesce(F.max("stop_row").isNotNull(), F.lit(False)).alias("stopped_early"),
    )


def run_contract(
    df: DataFrame, contract: dict[str, Rule], row_number: Column, max_errors: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(summary, errors) of the whole input. Missing required columns give one error and zero row counts.

    With ``max_errors`` the check ends, as a report for people does, at the row that passes the cap.
    """
    spark = df.sparkSession
    absent = missing_columns(df, contract)
    if absent:
        text = "Input CSV is missing required columns: " + ", ".join(absent)
        summary = spark.range(1).select(
            *[F.lit(0).cast("bigint").alias(c) for c in ("rows_checked", "valid_rows", "invalid_rows")],
            F.lit(1).cast("bigint").alias("error_count"),
            F.lit(False).alias("stopped_early"),
        )
        errors = spark.range(1).select(
            F.lit(None).cast("bigint").alias("row_number"), F.lit(0).alias("position"), F.lit(text).alias("error")
        )
        return summary, errors
    checked = check_rows(df, contract, row_number)
    if max_errors is None:
        return totals(checked).withColumn("stopped_early", F.lit(False)), error_list(checked)
    return capped_totals(checked, max_errors), capped_errors(checked, max_errors)


def status_code(summary: DataFrame) -> int:
    """0 when no error was recorded, 1 otherwise (2 is a ContractError raised to the caller)."""
    return 0 if summary.select("error_count").first()[0] == 0 else 1


def gate(summary: DataFrame) -> None:
    """Stop a run before ingestion when the contract found errors."""
    row = summary.first()
    if row["error_count"]:
        raise ContractError(f"contract check failed: {row['error_count']} error(s) in {row['invalid_rows']} row(s)")
