"""Dataset subsets: the first rows of an order, or an exact-size uniform sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ordering import first_rows


def clean_header(name: str) -> str:
    return name.lstrip("﻿").strip().strip('"')


def normalize_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_header(c) for c in df.columns])


def first_n(df: DataFrame, order: Column, n: int) -> DataFrame:
    if n <= 0:
        raise ValueError("rows must be a positive integer")
    return first_rows(df, [order], n)


def random_n(df: DataFrame, keys: list[str], n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, uniform over rows and repeatable for a seed.

    Rows are ranked by 30 hex digits of a seeded MD5 of their unique key, read as two numbers, so no
    shared random state and no sort of the whole input is needed.
    """
    if n <= 0:
        raise ValueError("rows must be a positive integer")
    digest = F.md5(F.concat_ws("-", F.lit(seed), *[F.col(k).cast("string") for k in keys]).cast("binary"))
    draws = [F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint") for at in (1, 16)]
    return first_rows(df, draws, n)
