"""Ranked lexical search: the best documents of every query by the Best Position Algorithm.

Queries are taken in blocks of BLOCK_ITEMS; each block meets all documents.

1. One scan of the texts keeps of every document its number of terms and the counts of the block's terms.
   From it come the number of documents with terms, the number of all terms and each term's documents.
2. Documents are searched in blocks of BLOCK_POSTINGS as they lie in their partitions. A block has one
   impact list for each term, highest impact first. Lists are read from the top, in growing steps. A
   document that is met for the first time is looked up in all lists of the query (direct access), which
   gives its whole score and marks its place in each list. The best position of a list is the end of its
   unbroken run of marked places: no document outside the marked ones can have more than the impact there.
   When the weighted sum of the impacts at the best positions is strictly below the k-th score, no other
   document can enter, not even by an equal score and a smaller doc_id, and the query stops.
3. What a task has found so far is the bound for its later blocks. A task returns at most k rows a query, and
   these are cut to k in two steps.

No text is shuffled and no list is ever whole in one task; a term in every document is as good as any other.

Defined cases: null or empty texts have no term, are not counted as documents and are never found; a null item
text finds nothing; an item without a known term has no rows; a score of 0 is not a hit. Repeated rows of
documents are ranked each by itself; equal rows of items are one item, and an item_id with two texts has two
lists. Equal scores go by doc_id, null doc_ids last. Without documents or items there are no rows. Only
doc_id, item_id and text are read, so other columns do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD_BYTES, stored

K = 10
BLOCK_ITEMS = 4096
BLOCK_POSTINGS = 1 << 20
FIRST_STEP = 16
PARTS = 64


def terms(text: str | None) -> list[bytes]:
    """Runs of digits, letters and anything outside ASCII; only A-Z are lower-cased."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Impact of a term with ``tf`` occurrences in documents of ``n`` terms, in whole numbers."""
    m = 25 + (75 * n * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _forward(vocabulary: dict[bytes, int]):
    find = vocabulary.get

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, ids, counts = [], [], []
            for text in batch["text"]:
                words = terms(text)
                known = [(i, c) for w, c in Counter(words).items() if (i := find(w)) is not None]
                sizes.append(len(words))
                ids.append(np.array([i for i, _ in known], np.int32))
                counts.append(np.array([c for _, c in known], np.int32))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n": sizes, "ids": ids, "tfs": counts})

    return run


class ImpactList:
    """One term's documents in a block: by falling impact to read from the top, by document to look one up."""

    def __init__(self, docs: np.ndarray, impacts: np.ndarray):
        """``docs`` ascends."""
        order = np.lexsort((docs, -impacts))
        self.by_doc, self.at_doc = docs, impacts
        self.docs, self.impacts = docs[order], impacts[order]

    def of(self, docs: np.ndarray) -> np.ndarray:
        """Impact in each of ``docs``, 0 where the term is absent."""
        place = np.minimum(np.searchsorted(self.by_doc, docs), len(self.by_doc) - 1)
        return np.where(self.by_doc[place] == docs, self.at_doc[place], 0)


def best_position_search(
    lists: list[ImpactList], weights: list[int], n_docs: int, k: int = K, least: int = 1
) -> tuple[np.ndarray, np.ndarray, int]:
    """The documents of the k best scores of at least ``least``: (documents, scores, documents looked up).

    Documents are numbers below ``n_docs`` whose order decides between equal scores.
    """
    seen, score = np.zeros(n_docs, bool), np.zeros(n_docs, np.int64)
    best = [0] * len(lists)
    read, step = 0, FIRST_STEP
    while True:
        met = np.unique(np.concatenate([one.docs[read:read + step] for one in lists]))
        met = met[~seen[met]]
        seen[met] = True
        for one, w in zip(lists, weights, strict=True):
            score[met] += w * one.of(met)
        read, step = read + step, step * 2
        ceiling = 0
        for i, one in enumerate(lists):
            ahead = seen[one.docs[best[i]:]]
            best[i] += len(ahead) if ahead.all() else int(ahead.argmin())
            if best[i] < len(one.docs):  # a list whose documents are all marked adds nothing to the others
                ceiling += weights[i] * int(one.impacts[best[i] - 1])
        found = np.flatnonzero(score >= least)
        if len(found) > k:
            found = found[np.lexsort((found, -score[found]))[:k]]
        bound = int(score[found].min()) if len(found) == k else least
        if ceiling < bound:
            found = found[np.lexsort((found, -score[found]))]
            return found, score[found], int(seen.sum())


class _Task:
    """Searches one task's blocks of documents and keeps the k best of every item."""

    def __init__(self, items, weights, n_docs, n_terms, k):
        self.items, self.weights, self.n_docs, self.n_terms, self.k = items, weights, n_docs, n_terms, k
        self.kept = [([], []) for _ in items]  # scores, doc_ids

    def search(self, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("doc_id", na_position="last", kind="stable")
        lengths = np.fromiter(map(len, rows["ids"]), np.int64, len(rows))
        if not lengths.sum():
            return
        doc = np.repeat(np.arange(len(rows)), lengths)
        term, tf = np.concatenate(rows["ids"].to_list()), np.concatenate(rows["tfs"].to_list()).astype(np.int64)
        impact = impacts(tf, rows["n"].to_numpy(np.int64)[doc], self.n_docs, self.n_terms)
        order = np.lexsort((doc, term))
        doc, term, impact = doc[order], term[order], impact[order]
        begin = np.searchsorted(term, np.arange(len(self.weights) + 1))
        lists = [ImpactList(doc[a:b], impact[a:b]) if b > a else None for a, b in zip(begin[:-1], begin[1:], strict=True)]
        names = rows["doc_id"].to_list()
        for item, kept in zip(self.items, self.kept, strict=True):
            here = [(t, c) for t, c in item if lists[t] and self.weights[t]]
            if not here:
                continue
            scores, ids = kept
            found, score, _ = best_position_search(
                [lists[t] for t, _ in here], [self.weights[t] * c for t, c in here], len(rows), self.k, scores[-1] if len(scores) == self.k else 1,
            )
            merged = sorted(
                [*zip(scores, ids, strict=True), *zip(score.tolist(), [names[d] for d in found], strict=True)],
                key=lambda x: (-x[0], pd.isna(x[1]), 0 if pd.isna(x[1]) else x[1]),
            )[:self.k]
            scores[:], ids[:] = [s for s, _ in merged], [d for _, d in merged]

    def rows(self) -> Iterator[pd.DataFrame]:
        out = [(i, d, s) for i, (scores, ids) in enumerate(self.kept) for s, d in zip(scores, ids, strict=True)]
        yield pd.DataFrame({
            "item": pd.array([x[0] for x in out], "Int32"), "doc_id": pd.array([None if pd.isna(x[1]) else x[1] for x in out], "Int64"),
            "score": pd.array([x[2] for x in out], "Int64"),
        })


def _searching(items, weights, n_docs, n_terms, k):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = _Task(items, weights, n_docs, n_terms, k)
        waiting, postings = [], 0
        for batch in batches:
            waiting.append(batch)
            postings += int(sum(map(len, batch["ids"]))) + len(batch)
            if postings >= BLOCK_POSTINGS:
                task.search(pd.concat(waiting))
                waiting, postings = [], 0
        if waiting:
            task.search(pd.concat(waiting))
        yield from task.rows()

    return run


def _block(docs: DataFrame, block: list, k: int) -> DataFrame | None:
    """Ranked documents of one block of (item_id, text); None where nothing can be found."""
    spark = docs.sparkSession
    words = [Counter(terms(text)) for _, text in block]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*words)))}
    forward = stored(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(
            _forward(vocabulary), "doc_id bigint, n bigint, ids array<int>, tfs array<int>"
        ).filter("n > 0"), "search-forward",
    )
    total = forward.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
    if not vocabulary or not total["docs"]:
        return None
    # one number for each term of the block
    df = dict(forward.select(F.explode("ids").alias("id")).groupBy("id").count().collect())
    weights = [weight(total["docs"], df.get(i, 0)) for i in range(len(vocabulary))]
    items = [[(vocabulary[w], c) for w, c in counted.items()] for counted in words]
    hits = forward.mapInPandas(
        _searching(items, weights, total["docs"], total["terms"], k), "item int, doc_id bigint, score bigint"
    ).withColumn("part", F.spark_partition_id() % PARTS)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for group in (["item", "part"], ["item"]):
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id bigint")
    # at most BLOCK_ITEMS rows
    return hits.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """The k best documents (doc_id, text) of every item (item_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    parts, block = [], []
    for row in items.select(F.col("item_id").cast("bigint"), "text").distinct().toLocalIterator():
        block.append((row[0], row[1]))
        if len(block) == BLOCK_ITEMS:
            parts.append(_block(docs, block, k))
            block = []
    if block:
        parts.append(_block(docs, block, k))
    parts = [p for p in parts if p is not None]
    if not parts:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
