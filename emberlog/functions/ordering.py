"""The first N rows of an order, and row numbers, without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 4096
SPLITS = 65_536


def _narrow(df: DataFrame, key: Column, wanted: int, low: int, high: int) -> tuple[int, int, bool]:
    """Smallest ``high`` such that at least ``wanted`` rows have ``key <= high``.

    Returns (cut value, rows below the cut value, exact): ``exact`` means the rows up to and
    including the cut value are precisely the wanted ones. Every pass counts rows per bucket of the
    key range; only the bucket counts, at most BUCKETS numbers, come to the driver.
    """
    below = 0
    while True:
        width = (high - low) // BUCKETS + 1
        bucket = F.floor((key.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / width).cast("bigint")
        counts = df.filter(key.between(low, high)).groupBy(bucket.alias("b")).count().collect()
        for slot, rows in sorted((r["b"], r["count"]) for r in counts):
            if below + rows >= wanted:
                low, high = low + slot * width, min(high, low + (slot + 1) * width - 1)
                if below + rows == wanted:
                    return high, below, True
                break
            below += rows
        if low == high:
            return low, below, False


def top_rows(df: DataFrame, keys: list[Column], n: int) -> DataFrame:
    """The n first rows for a list that people read: Spark's top-n, n rows per task at most."""
    return df.orderBy(*keys).limit(n)


def first_rows(df: DataFrame, keys: list[Column], n: int) -> DataFrame:
    """The n first rows as a data set, by ascending BIGINT keys (negate a key for descending order).

    The exact cut value of each key in turn is found by counting, and the rows are selected by a plain
    filter that reaches the scan: nothing is sorted and no task gathers the result. The key
    combination must be unique for an exact count. For a short list to read use ``top_rows``.
    """
    if n <= 0:
        return df.limit(0)
    chosen, tied, wanted = F.lit(False), F.lit(True), n
    for key in keys:
        open_rows = df.filter(tied)
        span = open_rows.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")).first()
        if span["n"] <= wanted:
            return df.filter(chosen | tied)
        cut, below, exact = _narrow(open_rows, key, wanted, span["low"], span["high"])
        if exact:
            return df.filter(chosen | (tied & (key <= cut)))
        chosen, tied, wanted = chosen | (tied & (key < cut)), tied & (key == cut), wanted - below
    # rows that share every key are interchangeable: any `wanted` of them complete the result
    return df.filter(chosen).unionByName(df.filter(tied).limit(wanted))


def newest_first(moment: Column, tie: Column) -> list[Column]:
    """Keys for newest first with missing times last, then the larger tie value first."""
    return [F.coalesce(-F.unix_micros(moment), F.lit(2**62)), -tie]


def _per_split(scanned: DataFrame) -> DataFrame:
    return scanned.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))


def split_starts(scanned: DataFrame) -> tuple[DataFrame, bool]:
    """Rows of its file before each split (_file, _block, _first, _before), and whether they may be broadcast.

    One counting pass. Up to SPLITS splits are added up here and sent to every task; a scan of more keeps them as
    a frame of its own, to be joined by shuffle.
    """
    found = _per_split(scanned).limit(SPLITS + 1).collect()
    if len(found) <= SPLITS:
        rows, before = [], {}
        for file, block, n, first in sorted(found):
            rows.append((file, block, first, before.get(file, 0)))
            before[file] = before.get(file, 0) + n
        return scanned.sparkSession.createDataFrame(rows, "_file string, _block bigint, _first bigint, _before bigint"), True
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return _per_split(scanned).select("_file", "_block", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")), False


def number_rows(rows: DataFrame, first: int = 1, scanned: DataFrame | None = None) -> DataFrame:
    """Row number within each file for a frame with ``_file``, ``_block`` and ``_seq`` columns.

    ``_block`` is the offset of the split a row was read from and ``_seq`` a counter that rises by
    one per row inside the split. ``rows`` may be a part of the ``scanned`` rows: only that part is joined.
    """
    starts, small = split_starts(rows if scanned is None else scanned)
    numbered = rows.join(F.broadcast(starts) if small else starts, ["_file", "_block"])
    return numbered.withColumn("row_number", F.col("_before") + F.col("_seq") - F.col("_first") + first).drop(
        "_before", "_first"
    )
