"""Benchmark decontamination by greedy string tiling.

A test item is covered by tiles: runs of at least LEAST words that stand in the document too. The
longest match is marked first, then again the longest among words not yet marked, so a passage whose
sentences were moved around is still covered. A document is contaminated when the tiles of some item
cover at least COVERAGE of its words.

Seeds are the rolling hashes of all runs of LEAST words of the items. Documents are scanned once; a
bit table of fixed size (built from the seeds) drops runs that are in no item, and the distinct rest of each document is
joined with the seeds on the full hash. A (document, item) pair whose shared seeds reach over too few of the item's words
is dropped; of the other pairs both texts meet in one row. There the longest run of unmarked words in both is found by
Karp-Rabin hashes of all runs of one length at falling lengths (the longest by halving, because a shared run has shared
parts), compared word by word and marked, until no run of LEAST words is left. Work grows with the lengths of the two
texts, not with their product, also where one word is repeated thousands of times.

An item of fewer than LEAST words is one run of its own width, and only the whole of it counts: documents
are hashed at the widths of such items too.

Words are runs of digits, letters a-z (A-Z lower-cased) and characters outside ASCII.

Defined cases: a null text is empty and clean; items without words give no evidence and
are not tested; equal items are tested separately, and of equally covered items the smallest item_id
is named; rows equal in doc_id and text share their result; empty documents or benchmarks give clean
results. Extra columns are kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD_BYTES, doc_key, mixed, near_keys, run_hashes, stored
from .skew import hot_keys, salted_join

LEAST = 5
COVERAGE = 0.5
BITS = 20


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def _runs(w: list[bytes], width: int = LEAST) -> np.ndarray:
    return run_hashes(w, width) if len(w) >= width else np.zeros(0, np.uint64)


def _seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for item, item_id, text in zip(batch["item"], batch["item_id"], batch["text"], strict=True):
            w = words(text)
            width = min(LEAST, len(w))
            runs = _runs(w, width) if w else []
            if len(runs):
                yield pd.DataFrame({
                    "seed": runs.view(np.int64), "item": item, "item_id": pd.array([item_id] * len(runs), dtype="Int64"),
                    "item_words": len(w), "item_at": np.arange(len(runs)),
                })


def _hits(table: np.ndarray, widths: tuple[int, ...]):
    """Distinct runs of a document that may be in an item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, seeds = [], []
            for key, text in zip(batch["doc_key"], batch["text"], strict=True):
                w = words(text)
                for width in widths:
                    runs = _runs(w, width)
                    found = np.unique(runs[table[runs >> np.uint64(64 - BITS)]])
                    keys += [key] * len(found)
                    seeds.append(found.view(np.int64))
            if keys:
                yield pd.DataFrame({"doc_key": keys, "seed": np.concatenate(seeds)})

    return run


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class _Side:
    """One text as word numbers, with the hash of every run and marks on the words that tiles have taken."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        powers = lambda base: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(numbers), base, np.uint64)]))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(numbers.astype(np.uint64) + np.uint64(1)) * powers(_BASE)[:-1])])
        self.shift = powers(_INVERSE)
        self.taken = np.zeros(len(numbers), bool)

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the runs of ``width`` words none of which is taken."""
        marked = np.concatenate([np.zeros(1, np.int64), np.cumsum(self.taken)])
        at = np.flatnonzero(marked[width:] == marked[:len(marked) - width])
        return at, (self.sums[at + width] - self.sums[at]) * self.shift[at]

    def free(self, at: int, width: int) -> bool:
        return not self.taken[at:at + width].any()


def _mark(doc: _Side, item: _Side, width: int) -> list[tuple[int, int, int]]:
    """Take all matches of ``width`` words, by their place in the item and then in the document."""
    doc_at, doc_hash = doc.runs(width)
    order = np.argsort(doc_hash, kind="stable")
    doc_at, doc_hash = doc_at[order], doc_hash[order]
    item_at, item_hash = item.runs(width)
    begin, end = np.searchsorted(doc_hash, item_hash), np.searchsorted(doc_hash, item_hash, "right")
    place: dict[int, int] = {}  # of each group of equal runs, the first that may still be free
    out = []
    for a, low, high in zip(item_at[end > begin].tolist(), begin[end > begin].tolist(), end[end > begin].tolist(), strict=True):
        if not item.free(a, width):
            continue
        at = place.get(low, low)
        while at < high and not doc.free(int(doc_at[at]), width):
            at += 1
        place[low] = at
        for b in doc_at[at:high].tolist():
            if doc.free(b, width) and (doc.numbers[b:b + width] == item.numbers[a:a + width]).all():
                out.append((a, b, width))
                item.taken[a:a + width] = doc.taken[b:b + width] = True
                break
    return out


def tiles(doc: list[bytes], item: list[bytes], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Greedy tiles (item start, document start, length) of two texts, given as words."""
    number: dict[bytes, int] = {}
    sides = [_Side(np.fromiter((number.setdefault(w, len(number)) for w in text), np.int64, len(text))) for text in (doc, item)]

    def shared(width: int) -> bool:
        return bool(np.isin(sides[1].runs(width)[1], sides[0].runs(width)[1]).any())

    out, limit = [], min(len(doc), len(item))
    while limit >= least and shared(least):
        low, high = least, limit
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if shared(middle) else (low, middle - 1)
        out += _mark(*sides, low)
        limit = low - 1
    return sorted(out)


TILE = "array<struct<item_from:int,doc_from:int,words:int>>"


def _tiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [
            tiles(words(text), words(item), min(LEAST, n))
            for text, item, n in zip(batch["text"], batch["item_text"], batch["item_words"], strict=True)
        ]
        yield pd.DataFrame({
            "doc_key": batch["doc_key"], "item": batch["item"], "item_id": batch["item_id"].astype("Int64"), "item_words": batch["item_words"],
            "covered": [sum(n for *_, n in f) for f in found],
            "tiles": [[{"item_from": a, "doc_from": b, "words": n} for a, b, n in f] for f in found],
        })


def _hot(rows: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` that hold much of ``rows``."""
    counts = stored(rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")), "tiling-counts")
    return hot_keys(counts, [key], "n", counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def overlaps(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Contaminated (document, item) pairs: doc_key, item, item_id, item_words, covered, tiles."""
    items = stored(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").withColumn("item", F.monotonically_increasing_id()), "tiling-items")
    seeds = stored(items.mapInPandas(_seeds, "seed bigint, item bigint, item_id bigint, item_words int, item_at int"), "tiling-seeds")
    # at most 2**BITS numbers, however large the benchmark is
    bits = seeds.select(F.shiftrightunsigned("seed", 64 - BITS).alias("bit")).distinct().collect()
    table = np.zeros(1 << BITS, bool)
    table[[r["bit"] for r in bits]] = True
    short = sorted(r["item_words"] for r in seeds.select("item_words").filter(F.col("item_words") < LEAST).distinct().collect())  # fewer than LEAST
    scanned = docs.select(doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"), "text")
    hits = stored(scanned.mapInPandas(_hits(table, (LEAST, *short)), "doc_key binary, seed bigint").distinct(), "tiling-hits")
    # a place of an item meets a document once, however often the document repeats the run
    pairs = salted_join(hits, seeds, ["seed"], _hot(hits, "seed")).groupBy("doc_key", "item").agg(
        F.any_value("item_id").alias("item_id"), F.any_value("item_words").alias("item_words"), F.collect_list("item_at").alias("places"),
    )
    reach = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + F.least(F.lit(LEAST), F.col("item_words")) - 1)))))
    able = stored(pairs.filter(reach >= coverage * F.col("item_words")).drop("places"), "tiling-able")
    named = salted_join(able, items.select("item", F.col("text").alias("item_text")), ["item"], _hot(able, "item"))
    texts = near_keys(scanned, able.select("doc_key").distinct()).groupBy("doc_key").agg(F.any_value("text").alias("text"))
    both = salted_join(named, texts, ["doc_key"], _hot(able, "doc_key"))
    tiled = both.mapInPandas(_tiled, f"doc_key binary, item bigint, item_id bigint, item_words int, covered int, tiles {TILE}")
    return stored(tiled.filter(F.col("covered") >= coverage * F.col("item_words")), "tiling-overlaps")


def report(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, contaminated, n_items, coverage, item_id, tiles (of the best item)."""
    share: Column = F.col("covered") / F.col("item_words")
    best = overlaps(docs, benchmark, coverage).groupBy("doc_key").agg(
        F.count(F.lit(1)).alias("n_items"), F.min(F.struct((-share).alias("order"), "item_id", "item", "tiles")).alias("best")
    )
    keyed = docs.select("doc_id", doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"))
    return keyed.join(best, "doc_key", "left").select(
        "doc_id", F.col("best").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce(-F.col("best.order"), F.lit(0.0)).alias("coverage"), F.col("best.item_id").alias("item_id"),
        F.coalesce("best.tiles", F.array().cast(TILE)).alias("tiles"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad = stored(overlaps(docs.select("doc_id", "text"), benchmark, coverage).select("doc_key").distinct(), "tiling-bad")
    keyed = docs.select(F.struct(*docs.columns).alias("row"), doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"))
    cleared = near_keys(keyed, bad).join(bad, "doc_key", "left_anti")
    return near_keys(keyed, bad, other=True).select("row.*").unionByName(cleared.select("row.*"))
