"""Joins whose keys may be hot: a few keys that hold a large share of the rows are dealt over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# a key is hot from this part of all rows on, so there are at most SHARE hot keys however large the input is
SHARE = 4096
SALTS = 32


def hot_keys(counts: DataFrame, keys: list[str], rows: str, total: int) -> DataFrame:
    """Keys of ``counts`` (one row a key) that hold a SHARE-th or more of ``total`` rows: at most SHARE."""
    return counts.filter((F.col(rows) * SHARE >= total) & (F.col(rows) > SALTS)).select(*keys)


def salted_join(left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """``left.join(right, keys, how)``; rows of ``left`` with a hot key go to SALTS tasks.

    ``right`` has few rows for each key; those of hot keys are repeated SALTS times. Null keys join nothing.
    """
    marks = F.broadcast(hot.select(*keys).withColumn("_hot", F.lit(True)))
    one = F.when(F.col("_hot"), F.pmod(F.hash(F.monotonically_increasing_id()), F.lit(SALTS))).otherwise(F.lit(0))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(marks, keys, "left").withColumn("_salt", one).drop("_hot")
    spread = right.join(marks, keys, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return dealt.join(spread, [*keys, "_salt"], how).drop("_salt")
