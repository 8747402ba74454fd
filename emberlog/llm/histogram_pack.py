"""Best-fit packing planned over a histogram of lengths.

Texts are tokenized and cut into pieces of at most CAPACITY tokens (only longer documents are cut; the
first piece takes the remainder, all others are full). Best-fit decreasing is run over the counts of
the lengths, never over documents: its state is a set of equal, consecutively numbered sequences for
each free space. Pieces then take the planned slots by joining on their rank within their length.

The plan depends on the capacity alone: each of at most CAPACITY lengths uses up sets of sequences or
splits one, so its rows do not grow with the corpus, and it is broadcast.

Defined cases: a null text is empty and has the end id only; null doc_ids and repeated rows are pieces
of their own; equal lengths are ranked by doc_id, piece and row; an empty table gives an empty result.
Other columns are not used.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import positions, stored
from .tokens import encoder

CAPACITY = 1024
END_ID = 2
STEP = "length int, from_rank bigint, to_rank bigint, from_sequence bigint, each int, from_offset int"


def _cutter(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "piece": [], "start": [], "length": [], "ids": []}
            size = 0
            for doc, got in zip(batch["doc_id"], encoder(path).ids(batch["text"]), strict=True):
                ids = np.append(got, end_id).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    for name, value in zip(out, (doc, piece, a, b - a, ids[a:b].tobytes()), strict=True):
                        out[name].append(value)
                size += len(ids)
                if size >= 1 << 20:
                    yield pd.DataFrame(out).astype({"doc_id": "Int64"})
                    out, size = {name: [] for name in out}, 0
            if out["piece"]:
                yield pd.DataFrame(out).astype({"doc_id": "Int64"})

    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Stored pieces of ``docs`` (doc_id, text): row, doc_id, piece, start, length, ids (little-endian uint32)."""
    cut = docs.select("doc_id", "text").mapInPandas(
        _cutter(tokenizer_path, capacity, end_id), "doc_id bigint, piece int, start bigint, length int, ids binary"
    )
    return stored(cut.withColumn("row", F.monotonically_increasing_id()), "pack-pieces")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    A step (length, from_rank, to_rank, from_sequence, each, from_offset) puts the pieces of a length
    with these ranks into consecutive sequences, ``each`` of them side by side in every one.
    """
    open_sets: dict[int, list[tuple[int, int]]] = {}  # free space: (first sequence, sequences)
    spaces: list[int] = []
    steps: list[tuple[int, int, int, int, int, int]] = []
    made = 0

    def put(space: int, first: int, count: int) -> None:
        if count and space:
            if space not in open_sets:
                open_sets[space] = []
                insort(spaces, space)
            open_sets[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, count = open_sets[space].pop()
                if not open_sets[space]:
                    del open_sets[space]
                    spaces.pop(at)
            else:
                space, first, count = capacity, made, max(1, left // (capacity // length))
                made += count
            each = space // length
            full = min(count, left // each)
            if not full:
                each, full = left, 1
            steps.append((length, rank, rank + full * each, first, each, capacity - space))
            put(space - each * length, first, full)
            put(space, first + full, count - full)
            rank, left = rank + full * each, left - full * each
    return steps


def assign(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """sequence_id and offset of every piece (needs row, doc_id, piece, length; other columns stay)."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    steps = F.broadcast(spark.createDataFrame(plan(histogram, capacity), STEP))
    before, firsts = 0, []
    for length in sorted(histogram):
        firsts.append((length, before))
        before += histogram[length]
    first = F.broadcast(spark.createDataFrame(firsts, "length int, first_rank bigint"))
    ranked = positions(cut, ["length", "doc_id", "piece", "row"], label="pack-ranks").join(first, "length")
    ranked = ranked.withColumn("rank", F.col("rank") - F.col("first_rank")).drop("first_rank")
    here = (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    slot = F.col("rank") - F.col("from_rank")
    return ranked.join(steps.withColumnRenamed("length", "_length"), (F.col("length") == F.col("_length")) & here).select(
        *cut.columns, (F.col("from_sequence") + F.floor(slot / F.col("each"))).cast("bigint").alias("sequence_id"),
        (F.col("from_offset") + (slot % F.col("each")) * F.col("length")).cast("bigint").alias("offset"),
    )


def sequences(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Packed sequences: sequence_id, length, pieces (offset, doc_id, piece, start, length), ids.

    A full piece is a sequence as it stands, numbered below zero by its row, and is not shuffled.
    """
    columns = ("offset", "doc_id", "piece", "start", "length")
    full = cut.filter(F.col("length") == capacity).withColumn("offset", F.lit(0).cast("bigint")).select(
        (-1 - F.col("row")).alias("sequence_id"), "length", F.array(F.struct(*columns)).alias("pieces"), "ids"
    )
    rest = cut.filter(F.col("length") < capacity)
    placed = assign(rest.drop("ids", "start"), capacity).select("row", "sequence_id", "offset")
    joined = rest.join(placed, "row")
    # at most ``capacity`` tokens and pieces meet in one group
    grouped = joined.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids"))).alias("p"))
    packed = grouped.select(
        "sequence_id", F.aggregate("p", F.lit(0), lambda n, p: n + p["length"]).alias("length"),
        F.transform("p", lambda p: F.struct(*[p[c].alias(c) for c in columns])).alias("pieces"),
        F.aggregate("p", F.lit(b""), lambda all_ids, p: F.concat(all_ids, p["ids"])).alias("ids"),
    )
    return full.unionByName(packed)
