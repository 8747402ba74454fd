"""Exact rounding, guarded division and integer coercion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WIDE = "decimal(20,0)"


def ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """``numerator / denominator`` rounded half up as a DECIMAL; NULL when the denominator is 0.

    Both inputs are whole numbers. DECIMAL(20,0) / DECIMAL(20,0) keeps 18 fraction digits, more than
    any tie at ``places`` digits can need, so the second rounding never moves a value over a tie.
    """
    return F.round(numerator.cast(WIDE) / F.nullif(denominator.cast(WIDE), F.lit(0).cast(WIDE)), places)


def rate(numerator: Column, denominator: Column, places: int = 4) -> Column:
    return ratio(numerator, denominator, places).cast("double")


def rounded_mean(column: Column, places: int = 2) -> Column:
    """Mean of a whole-number column over its non-null rows, rounded half up."""
    return rate(F.sum(column), F.count(column), places)


def exact_mean(column: Column, places: int = 2, scale: int = 6) -> Column:
    """Mean of readings with up to ``scale`` digits, added up exactly and rounded half up; NULL without rows."""
    total = F.sum(column.cast(f"decimal(20,{scale})"))
    count = F.nullif(F.count(column), F.lit(0)).cast("decimal(18,0)")
    return F.round(total / count, places).cast("double")


def quantize(column: Column, precision: int, scale: int = 6) -> Column:
    """Fix a DECIMAL at ``scale`` digits, half up."""
    return F.round(column, scale).cast(f"decimal({precision},{scale})")


def tally(condition: Column) -> Column:
    """Rows where the condition holds; NULL conditions count as not holding."""
    return F.count_if(condition)


def two_digits(value: str) -> str:
    """SQL of a number as text with two digits, exact ties to the even digit (as ``%.2f`` rounds)."""
    return f"format_number({value}, '0.00')"
