"""Near-duplicate classes by min-max hashing and exact confirmation.

A document is the set of its distinct shingles of WIDTH words (all words, if there are fewer). Of each
of PERMUTATIONS random permutations both the smallest and the largest value over the set are kept, so
half as many hash evaluations give the signature; each of the two agrees between two sets with the
probability of their Jaccard similarity. The 2 * PERMUTATIONS values are cut into BANDS bands of ROWS:
a pair at the threshold of 0.85 misses all bands with probability 2e-7.

1. Equal sets are one node from the start, so a group of copies is one row for each task.
2. Nodes that share a band are joined to the smallest node in it; the connected families of these
   links hold every candidate pair.
3. Families are cut into chunks of bounded size, in the order of set size. A task compares two chunks
   on full sets by one matrix product and returns a spanning forest of the links it found, never the
   pairs. Chunk pairs whose sizes cannot reach the threshold are left out.
4. The connected components of the confirmed links are the classes.

Defined cases: a null text is empty; a text without words is linked with nothing and is its own class;
rows equal in doc_id and text are one document and share its result; of a class the smallest doc_id
stays (nulls last, then by text digest), so a class of null doc_ids has a null component_id; an empty
table gives an empty result. Extra columns are not used here and are kept by ``deduplicated``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import components, doc_key, near_keys, positions, run_hashes, stored
from .skew import hot_keys, salted_join

WIDTH = 5
PERMUTATIONS = 140
ROWS = 7
BANDS = 2 * PERMUTATIONS // ROWS
NUMERATOR = 85  # links have 100 * intersection >= NUMERATOR * union
CHUNK = 1 << 18
LEAST_WEIGHT = 512
SLICE = 1024
NO_ID = 2**63 - 1

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 2**32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 2**32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)
_BAND = _random.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(run_hashes((text or "").encode("utf-8", "replace").lower().split(), width))


def set_key(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def signature(hashes: np.ndarray) -> np.ndarray:
    """Minimum and maximum of every permutation, side by side."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    low, top = np.full(PERMUTATIONS, 2**32 - 1, np.uint32), np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(high), SLICE):
        values = high[at:at + SLICE, None] * _FACTORS + _SHIFTS
        low, top = np.minimum(low, values.min(0)), np.maximum(top, values.max(0))
    return np.stack([low, top], 1).ravel()


def bands(sig: np.ndarray) -> np.ndarray:
    values = (sig.reshape(BANDS, ROWS).astype(np.uint64) * _BAND).sum(1)
    return (values ^ (values >> np.uint64(32))).view(np.int64)


def _sketches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingles(t) for t in batch["text"]]
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].astype("Int64"), "doc_key": batch["doc_key"], "n_shingles": [len(s) for s in sets],
            "key": [set_key(s) for s in sets], "bands": [bands(signature(s)) if len(s) else None for s in sets],
        })


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingles(t) for t in batch["text"]]
        # a doc_id may name several texts; only the one the node was made from counts
        right = np.array([set_key(s) == k for s, k in zip(sets, batch["key"], strict=True)], bool)
        yield pd.DataFrame({
            "key": batch["key"][right], "hashes": [s.tobytes() for s, r in zip(sets, right, strict=True) if r],
        })


def forest(sets: list[np.ndarray], numerator: int = NUMERATOR) -> list[tuple[int, int]]:
    """Spanning forest (member, root) of the links among sets, from exact intersection sizes."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.float64)
    values, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes.astype(np.int64))
    shared = times[place] > 1
    columns = np.cumsum(times > 1) - 1
    row, column = row[shared], columns[place[shared]]
    common = np.zeros((n, n), np.float32)
    width = 4096
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for at in range(0, int((times > 1).sum()), width):
        a, b = np.searchsorted(column, [at, at + width])
        part = np.zeros((n, width), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        common += part @ part.T
    linked = 100 * common.astype(np.float64) >= numerator * (sizes[:, None] + sizes[None, :] - common)
    root = np.arange(n)
    while True:
        new = np.where(linked, root[None, :], n).min(1)
        new = np.minimum(new, root)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return [(i, int(r)) for i, r in enumerate(root) if i != r]


def _links(numerator: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("key")
        keys = group["key"].tolist()
        found = forest([np.frombuffer(h, np.uint64) for h in group["hashes"]], numerator)
        return pd.DataFrame({"a": [keys[i] for i, _ in found], "b": [keys[r] for _, r in found]}, dtype=object)

    return run


def candidates(nodes: DataFrame) -> DataFrame:
    """Links (a, b) from each node to the smallest node that shares a band with it."""
    in_band = nodes.select("key", F.posexplode("bands").alias("band", "value"))
    # counted before the shuffle; most bands hold one node and end here
    hubs = stored(in_band.groupBy("band", "value").agg(
        F.min("key").alias("hub"), F.max("key").alias("top"), F.count(F.lit(1)).alias("n")
    ).filter(F.col("hub") != F.col("top")), "dedup-hubs")
    hot = hot_keys(hubs, ["band", "value"], "n", hubs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    return salted_join(in_band, hubs.drop("top", "n"), ["band", "value"], hot).filter(F.col("key") != F.col("hub")).select(
        F.col("key").alias("a"), F.col("hub").alias("b")
    ).distinct()


def confirmed(docs: DataFrame, nodes: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """Links (a, b) of full sets, a spanning forest of every pair of chunks."""
    family = components(candidates(nodes), "dedup-families")
    members = family.withColumnRenamed("node", "key").withColumnRenamed("root", "family").join(
        nodes.select("key", "n_shingles", "first"), "key"
    ).withColumn("weight", F.greatest("n_shingles", F.lit(LEAST_WEIGHT)))
    placed = positions(members.select("family", "n_shingles", "key", "first", "weight"), ["family", "n_shingles", "key"], {"before": "weight"}, "dedup-order")
    placed = stored(placed, "dedup-places")
    begin = placed.groupBy("family").agg(F.min("before").alias("begin"))
    chunked = stored(placed.join(begin, "family").select(
        "family", "key", "first", "n_shingles", F.floor((F.col("before") - F.col("begin")) / CHUNK).alias("chunk")
    ), "dedup-chunks")
    spans = chunked.groupBy("family", "chunk").agg(F.min("n_shingles").alias("low"), F.max("n_shingles").alias("high"))
    later = spans.select("family", F.col("chunk").alias("other"), F.col("low").alias("other_low"))
    tasks = stored(spans.join(later, "family").filter(
        (F.col("chunk") <= F.col("other")) & (100 * F.col("high") >= numerator * F.col("other_low"))
    ).select("family", "chunk", "other"), "dedup-tasks")
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"), "text")
    wanted = chunked.select(F.col("first.id").alias("id"), F.col("first.doc_key").alias("doc_key"), "key")
    sets = stored(near_keys(texts, wanted).join(wanted, ["id", "doc_key"]).select("key", "text").mapInPandas(_members, "key binary, hashes binary"), "dedup-sets")
    sides = tasks.select("family", "chunk", "other", F.explode(F.array_distinct(F.array("chunk", "other"))).alias("side"))
    dealt = chunked.select("family", F.col("chunk").alias("side"), "key").join(sides, ["family", "side"]).join(sets, "key")
    return dealt.select("family", "chunk", "other", "key", "hashes").groupBy("family", "chunk", "other").applyInPandas(
        _links(numerator), "a binary, b binary"
    )


def classes(docs: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, doc_key, n_shingles, component_id, kept (doc_id is the
    component's), representative (the one text that stays, where several texts have that doc_id)."""
    keyed = docs.select("doc_id", doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"), "text")
    sketched = stored(keyed.mapInPandas(
        _sketches, "doc_id bigint, doc_key binary, n_shingles bigint, key binary, bands array<bigint>"
    ), "dedup-sketches")
    name = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "doc_key")
    nodes = stored(sketched.filter("n_shingles > 0").groupBy("key").agg(
        F.min(name).alias("first"), F.max("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands")
    ), "dedup-nodes")
    roots = stored(components(confirmed(docs, nodes, numerator), "dedup-links"), "dedup-roots")
    named = roots.join(nodes.select(F.col("key").alias("node"), "first"), "node")
    of_root = named.groupBy("root").agg(F.min("first").alias("best"))
    linked = named.join(of_root, "root").select(F.col("node").alias("key"), "best")
    best = stored(nodes.select("key", "first").join(linked, "key", "left").select("key", F.coalesce("best", "first").alias("best")), "dedup-best")
    rows = sketched.select("doc_id", "doc_key", "n_shingles", "key").join(best, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.nullif(F.col("best.id"), F.lit(NO_ID)))
    single = F.col("key").isNull() | (F.col("best.doc_key") == F.col("doc_key"))
    return rows.select(
        "doc_id", "doc_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        single.alias("representative"),
    )


def deduplicated(docs: DataFrame, numerator: int = NUMERATOR) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of equal rows one stays."""
    found = classes(docs.select("doc_id", "text"), numerator).groupBy("doc_key").agg(F.count(F.lit(1)).alias("copies"), F.bool_and("representative").alias("kept"))
    # only rows that go or are repeated need to be looked up; the others never leave their partition
    changed = stored(found.filter("copies > 1 or not kept"), "dedup-changed")
    own = docs.columns
    keyed = docs.select(
        F.struct(*own).alias("row"), doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"), F.monotonically_increasing_id().alias("at")
    )
    # places are stored with the rows, because a frame that is shuffled may give its rows other places when it is read again
    looked_up = stored(near_keys(keyed, changed).join(changed.filter("not kept"), "doc_key", "left_anti"), "dedup-looked-up")
    # the first of equal rows, by its place: copies are reduced inside each task and no task meets all of them
    first = looked_up.groupBy("doc_key").agg(F.min("at").alias("at")).select("at")
    single = looked_up.join(first, "at", "left_semi")
    return near_keys(keyed, changed, other=True).select("row.*").unionByName(single.select("row.*"))
