"""Line dedup that can be taken back: sharded cuckoo filters in front of exact reference counts.

A line's key is the line without white space at its ends and with A-Z in lower case; keys of fewer than LEAST
code points are never duplicates. A key is held as its 128-bit digest (hi, lo).

The index has three tables:

* ``lines``: one row for each document with the distinct keys of its lines; written by a map over the texts,
  never shuffled. This is the exact record that everything else can be made from.
* ``filters``: for every shard of the hash space a cuckoo filter of the distinct ``hi`` in it: buckets of four
  16-bit fingerprints, each with two possible buckets. A full table is followed by another of the same shape,
  so a fingerprint can be taken out of any of them. Entries can be deleted, which a Bloom filter cannot do.
* ``counts``: exact references (rows, smallest and largest doc_id) of every key that a filter has met twice. A
  key without a row here has one reference.

Inserting documents probes the filters with the distinct ``hi`` of the new lines and adds those they do not
have. Only lines that a filter knows, or that the new documents hold twice, go on to the exact counts: unique
lines, most of a corpus, cost eight bytes in one pre-aggregated shuffle and nothing more. Fingerprints that
agree by chance cost a needless exact count and change nothing. Deleting documents recounts the keys they
shared and takes the fingerprints of keys without references out of the filters, so an index after a deletion
decides like one that never had the documents. When lines outgrow the shards (GROWTH), filters are built
anew with more shards from ``lines``.

A key held by a large share of the documents is one row after the first aggregation; its documents are
dealt over many tasks (``skew.salted_join``).

Defined cases: a null or empty text is one empty line. Lines are split at line feeds only. Documents are told
apart by doc_id: rows with the same doc_id are one document, null doc_ids are one document that comes after
all others, and repeated rows each return a result. A repeated line inside the smallest document that holds
it stays as often as it is there. Inserting a row (doc_id and text) that the index has changes nothing; a row
repeated inside one insertion counts as so many references and is no duplicate of itself; deleting an unknown doc_id changes nothing. Empty tables give empty results. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import doc_key, mixed, near_keys, stored
from .skew import hot_keys, salted_join

LEAST = 10
BUCKETS = 1 << 14
SLOTS = 4
FULL = int(BUCKETS * SLOTS * 0.85)
HALF_FULL = BUCKETS * SLOTS // 2
GROWTH = 8
ROUNDS = 400
PREFIX_BITS = 20
KEY = ["hi", "lo"]

LINES = "doc_key binary, doc_id bigint, hi array<bigint>, lo array<bigint>"
FILTERS = "shard int, items bigint, slots binary"
COUNTS = "hi bigint, lo bigint, refs bigint, low bigint, high bigint, nameless bigint"


def line_key(line: bytes) -> bytes | None:
    """16 bytes that stand for a line, None if it is too short to be a duplicate."""
    key = line.strip().lower()
    if len(key) < LEAST or (len(key) < 4 * LEAST and len(key.decode("utf-8", "replace")) < LEAST):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        pairs = []
        for text in batch["text"]:
            keys = {k for line in (text or "").encode("utf-8", "replace").split(b"\n") if (k := line_key(line))}
            pairs.append(np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2))
        yield pd.DataFrame({
            "doc_key": batch["doc_key"], "doc_id": batch["doc_id"].astype("Int64"), "hi": [p[:, 0] for p in pairs], "lo": [p[:, 1] for p in pairs],
        })


def lines_of(docs: DataFrame) -> DataFrame:
    """Rows of LINES, one for each row of ``docs``."""
    keyed = docs.select(doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return keyed.mapInPandas(_lines, LINES)


# --- one shard's filter -----------------------------------------------------------------------

class CuckooFilter:
    """Fingerprints of distinct 64-bit hashes in tables of one shape."""

    def __init__(self, slots: bytes | None = None, items: int = 0):
        self.tables = np.frombuffer(slots, np.uint16).reshape(-1, BUCKETS, SLOTS).copy() if slots else np.zeros((1, BUCKETS, SLOTS), np.uint16)
        self.items = items

    @staticmethod
    def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint (never 0) and the two buckets of each hash."""
        h = mixed(hashes.view(np.uint64) + np.uint64(0x51ED270B))
        mark = (h & np.uint64(0xFFFF)) % np.uint64(65535) + np.uint64(1)
        first = (h >> np.uint64(20)) % np.uint64(BUCKETS)
        return mark.astype(np.uint16), first.astype(np.int64), (first ^ CuckooFilter.turn(mark)).astype(np.int64)

    @staticmethod
    def turn(mark: np.ndarray) -> np.ndarray:
        """What leads from either bucket of a fingerprint to the other."""
        return mixed(mark.astype(np.uint64)) % np.uint64(BUCKETS)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        mark, a, b = self.places(hashes)
        return ((self.tables[:, a] == mark[:, None]) | (self.tables[:, b] == mark[:, None])).any((0, 2))

    def insert(self, hashes: np.ndarray) -> None:
        """Add hashes that are not in the filter, each once."""
        mark, bucket, _ = self.places(hashes)
        self.items += len(hashes)
        while len(mark):
            room = FULL - int((self.tables[-1] > 0).sum())
            later = mark[max(room, 0):], bucket[max(room, 0):]
            mark, bucket = self._fill(self.tables[-1], mark[:max(room, 0)], bucket[:max(room, 0)])
            mark, bucket = np.concatenate([mark, later[0]]), np.concatenate([bucket, later[1]])
            if len(mark):
                self.tables = np.concatenate([self.tables, np.zeros((1, BUCKETS, SLOTS), np.uint16)])

    def _fill(self, table: np.ndarray, mark: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Put fingerprints into their buckets, moving others to their second bucket; returns what finds no place."""
        for turn in range(ROUNDS):
            if not len(mark):
                break
            order = np.argsort(bucket, kind="stable")
            mark, bucket = mark[order], bucket[order]
            begin = np.r_[True, bucket[1:] != bucket[:-1]]
            rank = np.arange(len(bucket)) - np.flatnonzero(begin)[np.cumsum(begin) - 1]
            free = table[bucket] == 0
            fits = rank < free.sum(1)
            # the rank-th free slot of the bucket
            slot = (np.cumsum(free[fits], 1) == rank[fits, None] + 1).argmax(1)
            table[bucket[fits], slot] = mark[fits]
            mark, bucket, rank = mark[~fits], bucket[~fits], rank[~fits]
            # after a try of both buckets, one of a bucket's waiting fingerprints takes a slot there, and what stood in
            # it goes to its other bucket, as the other waiting ones do
            leads = np.r_[True, bucket[1:] != bucket[:-1]][:len(bucket)]
            if turn:
                slot = (bucket[leads] + turn) % SLOTS
                out = table[bucket[leads], slot]
                table[bucket[leads], slot] = mark[leads]
                mark = mark.copy()
                mark[leads] = out
            bucket = (bucket.astype(np.uint64) ^ self.turn(mark)).astype(np.int64)
        return mark, bucket

    def delete(self, hashes: np.ndarray) -> None:
        """Take out one fingerprint for each hash; hashes must have been inserted."""
        for mark, a, b in zip(*self.places(hashes), strict=True):
            for bucket in (a, b):
                table, slot = np.nonzero(self.tables[:, bucket] == mark)
                if len(table):
                    self.tables[table[0], bucket, slot[0]] = 0
                    self.items -= 1
                    break


def _filter_rows(shard: int, one: CuckooFilter, hits: np.ndarray) -> pd.DataFrame:
    """The shard's new filter, and the hashes to be counted exactly, as rows of one table."""
    return pd.DataFrame({
        "shard": pd.array([shard] * (1 + len(hits)), "Int32"), "items": pd.array([one.items, *[None] * len(hits)], "Int64"),
        "slots": [one.tables.tobytes(), *[None] * len(hits)], "hi": pd.array([None, *hits.tolist()], "Int64"),
    })


def _loaded(rows: pd.DataFrame) -> CuckooFilter:
    return CuckooFilter(rows["slots"].iloc[0], int(rows["items"].iloc[0])) if len(rows) else CuckooFilter()


def _inserting(key: tuple, new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    one = _loaded(old)
    hashes, rows = new["hi"].to_numpy(np.int64), new["n"].to_numpy(np.int64)
    known = one.contains(hashes) if len(hashes) else np.zeros(0, bool)
    one.insert(hashes[~known])
    return _filter_rows(key[0], one, hashes[known | (rows > 1)])


def _deleting(key: tuple, gone: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    one = _loaded(old)
    one.delete(gone["hi"].to_numpy(np.int64))
    return _filter_rows(key[0], one, np.zeros(0, np.int64))


_OUT = "shard int, items bigint, slots binary, hi bigint"


def _shard(bits: int) -> Column:
    return F.shiftrightunsigned("hi", 64 - bits).cast("int")


# --- the index --------------------------------------------------------------------------------

def _few(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose ``hi`` may be among ``wanted``; told apart by PREFIX_BITS bits, so the broadcast is bounded."""
    prefix = F.shiftrightunsigned("hi", 64 - PREFIX_BITS).alias("_prefix")
    return rows.withColumn("_prefix", prefix).join(F.broadcast(wanted.select(prefix).distinct()), "_prefix", "left_semi").drop("_prefix")


def _pairs(lines: DataFrame) -> DataFrame:
    """One row for each key of each document."""
    return lines.select("doc_key", "doc_id", F.explode(F.arrays_zip("hi", "lo")).alias("k")).select("doc_key", "doc_id", "k.hi", "k.lo")


def _same_document(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


@dataclass(frozen=True)
class LineIndex:
    """A version of the index; updates return the next version and leave this one as it is."""

    spark: SparkSession
    lines: DataFrame
    filters: DataFrame
    counts: DataFrame
    bits: int = 1
    rows: int = 0  # keys in ``lines``, repeated ones included

    @classmethod
    def empty(cls, spark: SparkSession) -> LineIndex:
        return cls(spark, *[spark.createDataFrame([], schema) for schema in (LINES, FILTERS, COUNTS)])

    def _hot(self, batch: DataFrame, rows: int) -> DataFrame:
        """Hashes that hold much of the index or of ``batch`` (hi, n): bounded, see ``skew``."""
        known = self.counts.groupBy("hi").agg(F.sum("refs").alias("n"))
        return hot_keys(batch, ["hi"], "n", rows).union(hot_keys(known, ["hi"], "n", self.rows)).distinct()

    def _filtered(self, hashes: DataFrame, filters: DataFrame, bits: int, step) -> DataFrame:
        dealt = hashes.withColumn("shard", _shard(bits)).groupBy("shard").cogroup(filters.groupBy("shard"))
        return stored(dealt.applyInPandas(step, _OUT), "line-filters")

    def _counted(self, hashes: DataFrame, lines: DataFrame, hot: DataFrame) -> DataFrame:
        """Exact references in ``lines`` of all keys with one of ``hashes``."""
        pairs = _few(_pairs(lines), hashes)
        pairs = salted_join(pairs, hashes.select("hi"), ["hi"], hot)
        return pairs.groupBy("hi", "lo").agg(
            F.count(F.lit(1)).alias("refs"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count_if(F.col("doc_id").isNull()).alias("nameless")
        )

    def _with_counts(self, hashes: DataFrame, lines: DataFrame, hot: DataFrame) -> DataFrame:
        """``counts`` with the keys of ``hashes`` counted anew in ``lines``."""
        fresh = self._counted(hashes, lines, hot).filter("refs > 1")
        return stored(self.counts.join(hashes, "hi", "left_anti").select(*KEY, "refs", "low", "high", "nameless").unionByName(fresh), "line-counts")

    def insert(self, docs: DataFrame) -> LineIndex:
        """The index with the documents (doc_id, text) added."""
        new = lines_of(docs)
        if self.rows:
            new = new.join(self.lines.select("doc_key"), "doc_key", "left_anti").select("doc_key", "doc_id", "hi", "lo")
        new = stored(new, "line-keys")
        lines = new if not self.rows else self.lines.unionByName(new)
        seen = stored(new.select(F.explode("hi").alias("hi")).groupBy("hi").agg(F.count(F.lit(1)).alias("n")), "line-hashes")
        size = seen.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
        items = self.filters.agg(F.coalesce(F.sum("items"), F.lit(0))).first()[0]
        filters, bits = self.filters, self.bits
        if items + size["keys"] > GROWTH * FULL * 2**bits or not self.rows:
            bits = max(1, ((items + size["keys"]) // HALF_FULL).bit_length())
            if items:
                old = self.lines.select(F.explode("hi").alias("hi")).groupBy("hi").agg(F.lit(1).cast("bigint").alias("n"))
                filters = self._filtered(old, self.spark.createDataFrame([], FILTERS), bits, _inserting).filter("slots is not null").drop("hi")
        out = self._filtered(seen, filters, bits, _inserting)
        suspects = out.filter("hi is not null").select("hi")
        counts = self._with_counts(suspects, lines, self._hot(seen, size["rows"]))
        return replace(self, lines=lines, filters=out.filter("slots is not null").drop("hi"), counts=counts, bits=bits, rows=self.rows + size["rows"])

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """The index without the documents of a column ``doc_id``."""
        named = doc_ids.select(F.col("doc_id").cast("bigint").alias("gone")).distinct()
        lines = stored(self.lines.join(named, _same_document("doc_id", "gone"), "left_anti"), "line-keys")
        dropped = self.lines.join(named, _same_document("doc_id", "gone"), "left_semi")
        his = stored(dropped.select(F.explode("hi").alias("hi")).groupBy("hi").agg(F.count(F.lit(1)).alias("n")), "line-hashes")
        rows = his.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        shared = his.join(self.counts.select("hi").distinct(), "hi", "left_semi")
        # a hash of keys that have one reference each may still name two keys: what is left is looked up
        left = self._counted(his.select("hi"), lines, self._hot(his, rows)).select("hi").distinct()
        out = self._filtered(his.join(left, "hi", "left_anti"), self.filters, self.bits, _deleting).filter("slots is not null").drop("hi")
        counts = self._with_counts(shared.select("hi"), lines, self._hot(his, rows))
        return replace(self, lines=lines, filters=out, counts=counts, rows=self.rows - rows)

    def duplicates(self) -> DataFrame:
        """Keys found in two documents or more: hi, lo, refs, low (the document that keeps them)."""
        several = (F.col("low") != F.col("high")) | ((F.col("nameless") > 0) & F.col("low").isNotNull())
        return self.counts.filter(several).select(*KEY, "refs", "low")

    def kept(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped and kept_text of every row of ``docs`` (doc_id, text)."""
        keyed = docs.select(doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        shared = stored(self.duplicates(), "line-duplicates")
        pairs = _few(_pairs(lines_of(docs)), shared)
        hot = hot_keys(shared, KEY, "refs", self.rows)
        goes = salted_join(pairs, shared.drop("refs"), KEY, hot).filter(~_same_document("doc_id", "low"))
        # at most the lines of one document; equal rows are counted for dealing them out
        drops = stored(goes.groupBy("doc_key").agg(
            F.collect_set(F.struct(*KEY)).alias("drops"), F.count(F.lit(1)).alias("n")
        ).withColumn("n", F.floor(F.col("n") / F.size("drops")).cast("bigint")), "line-drops")
        total = drops.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        touched = salted_join(near_keys(keyed, drops), drops.drop("n"), ["doc_key"], hot_keys(drops, ["doc_key"], "n", total), "left")
        whole = near_keys(keyed, drops, other=True).select(
            "doc_id", F.lit(0).cast("bigint").alias("n_dropped"), F.coalesce("text", F.lit("")).alias("kept_text"),
            F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("bigint").alias("n_lines"),
        )
        cut = touched.select(
            "doc_id", "text", F.transform("drops", lambda d: d["hi"]).alias("hi"), F.transform("drops", lambda d: d["lo"]).alias("lo")
        ).mapInPandas(_cut, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_text string")
        return cut.unionByName(whole)


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, hi, lo in zip(batch["text"], batch["hi"], batch["lo"], strict=True):
            lines = (text or "").encode("utf-8", "replace").split(b"\n")
            drops = set() if hi is None else {p.tobytes() for p in np.stack([hi, lo], 1).astype(np.int64)}
            stays = [line for line in lines if line_key(line) not in drops] if drops else lines
            out.append((len(lines), len(lines) - len(stays), b"\n".join(stays).decode("utf-8")))
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].astype("Int64"), "n_lines": [x[0] for x in out], "n_dropped": [x[1] for x in out], "kept_text": [x[2] for x in out],
        })
