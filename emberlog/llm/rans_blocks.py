"""Token-ID output: token streams coded with a static range asymmetric numeral system.

A data set has two tables below one folder: ``table`` (token, frequency), shared by all blocks and
scaled to 2**SCALE, and ``blocks``, one row per block: range, block, first_token, n_docs, n_tokens,
payload, crc32. Documents are in ascending doc_id order by (range, block); a block holds whole
documents and is closed by the document with which it reaches BLOCK tokens. Blocks depend on nothing
but the table, so they are decoded in parallel and a damaged one is found by its checksum.

Inside a block, up to LANES coders run interleaved: token t belongs to lane t mod lanes, and one step
codes one token of every lane with array arithmetic. Every CHECKPOINT steps the lane states and the
place in the word stream are stored, so a reader can start in the middle of a block.

Payload, little-endian: magic, six uint32 (tokens, lanes, steps, documents, checkpoints, words), then
doc_ids int64, a byte for each doc_id that is 1 for null, document lengths uint32, checkpoints (word
position uint32 each, then uint64 states each), stream words uint32.

Defined cases: a null text is empty and has the end id only; null doc_ids come first; rows with equal
doc_id are ordered by text; repeated rows stay rows; an empty table gives no blocks; a document may be
of any length, its block is then as large as the document. Other columns are not used.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import stored
from .tokens import encoder

MAGIC = b"EMBRANS1"
SCALE = 20
BLOCK = 1 << 18
LANES = 1024
CHECKPOINT = 128
LOW = 1 << 31  # states stay in [2**31, 2**63); words of 32 bits leave and enter
END_ID = 2
_HEAD = struct.Struct("<6I")


def scaled(counts: dict[int, int]) -> dict[int, int]:
    """Frequencies that sum to 2**SCALE, at least 1 for every token that occurs."""
    whole, total = 1 << SCALE, sum(counts.values())
    if len(counts) > whole:
        raise ValueError("more distinct tokens than the frequency scale can hold")
    freq = {t: max(1, n * whole // total) for t, n in counts.items()}
    rest = whole - sum(freq.values())
    for t in sorted(freq, key=lambda t: (-freq[t], t)):
        change = max(rest, 1 - freq[t])
        freq[t] += change
        rest -= change
        if not rest:
            break
    return freq


def _listed(freq: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    tokens = sorted(freq)
    return np.array(tokens, np.uint32), np.array([freq[t] for t in tokens], np.int64)


class Table:
    """Arrays of a shared frequency table."""

    def __init__(self, freq: dict[int, int]):
        self._fill(*_listed(freq))

    @classmethod
    def of(cls, tokens: np.ndarray, counts: np.ndarray) -> Table:
        """From ascending tokens and their frequencies, which travel to tasks better than a dictionary."""
        table = cls.__new__(cls)
        table._fill(tokens, counts)
        return table

    def _fill(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        size = int(tokens[-1]) + 1 if len(tokens) else 1
        # states stay below 2**63, so all arithmetic is signed and a token is an index as it stands
        self.freq, self.start = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.freq[tokens] = counts
        self.start[tokens] = np.cumsum(counts) - counts
        self.slots = np.repeat(tokens.astype(np.int32), counts)


def encode(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, lengths: np.ndarray, table: Table) -> bytes:
    """Payload of a block: token ids of documents ``doc_ids`` (null where ``nulls`` is 1) of ``lengths`` tokens."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 64))
    steps = -(-n // lanes)
    # the last step is filled up with the last token; a reader stops after n tokens
    grid = np.concatenate([ids, np.repeat(ids[-1:], steps * lanes - n)]).reshape(steps, lanes)
    state = np.full(lanes, LOW, np.int64)
    freqs, starts = table.freq[grid], table.start[grid]
    words, marks = [None] * steps, {}
    for t in range(steps - 1, -1, -1):
        freq = freqs[t]
        # a state from 2**(63 - SCALE) * freq on gives its low word away
        full = (state >> (63 - SCALE) >= freq).nonzero()[0]
        over = state.take(full)
        words[t] = over.astype(np.uint32)
        state[full] = over >> 32
        # quotient * 2**SCALE + remainder + start; division without signs is faster
        quotient = (state.view(np.uint64) // freq.view(np.uint64)).view(np.int64)
        state += quotient * ((1 << SCALE) - freq) + starts[t]
        if t % CHECKPOINT == 0:
            marks[t] = state.copy()
    before = np.cumsum([0, *map(len, words)])
    at = sorted(marks)
    return b"".join([
        MAGIC, _HEAD.pack(n, lanes, steps, len(doc_ids), len(at), int(before[-1])),
        doc_ids.astype("<i8").tobytes(), nulls.astype("u1").tobytes(), lengths.astype("<u4").tobytes(),
        np.array([before[t] for t in at], "<u4").tobytes(), *[marks[t].astype("<u8").tobytes() for t in at],
        *[w.astype("<u4").tobytes() for w in words],
    ])


class Block:
    """A payload opened for reading."""

    def __init__(self, payload: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a block of this format")
        self.n, self.lanes, self.steps, n_docs, n_marks, n_words = _HEAD.unpack_from(payload, 8)
        at = 8 + _HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(payload, kind, count, at)
            at += got.nbytes
            return got

        ids, nulls = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if null else int(d) for d, null in zip(ids, nulls, strict=True)]
        self.lengths = take("<u4", n_docs).astype(np.int64)
        self.marks = take("<u4", n_marks)
        self.states = take("<u8", n_marks * self.lanes).reshape(n_marks, self.lanes)
        self.words = take("<u4", n_words)

    def decode(self, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
        """Tokens ``first`` to ``last`` (exclusive), from the checkpoint before ``first``."""
        last = self.n if last is None else min(last, self.n)
        mark = first // self.lanes // CHECKPOINT
        begin, end = mark * CHECKPOINT, -(-last // self.lanes)
        if first >= last:
            return np.zeros(0, np.uint32)
        state, place = self.states[mark].astype(np.int64), int(self.marks[mark])
        out = np.empty((end - begin, self.lanes), np.uint32)
        for t in range(end - begin):
            slot = state & ((1 << SCALE) - 1)
            token = out[t] = table.slots.take(slot)
            state >>= SCALE
            state *= table.freq.take(token)
            state += slot
            state -= table.start.take(token)
            need = (state < LOW).nonzero()[0]
            n = len(need)
            if n:
                state[need] = (state.take(need) << 32) | self.words[place:place + n]
                place += n
        offset = begin * self.lanes
        return out.reshape(-1)[first - offset:last - offset]


class _Counts:
    """Occurrences of each token id."""

    def __init__(self):
        self.n = np.zeros(1 << 16, np.int64)

    def add(self, ids: np.ndarray) -> None:
        got = np.bincount(ids, minlength=len(self.n))
        got[:len(self.n)] += self.n
        self.n = got

    def rows(self) -> tuple[bytes, bytes]:
        seen = np.flatnonzero(self.n)
        return seen.astype("<i8").tobytes(), self.n[seen].astype("<i8").tobytes()


def _blocks_of(path: str, end_id: int):
    """Blocks of a task's documents, and a last row (block -1) with the counts of its tokens in doc_ids and lengths."""
    tail = np.array([end_id], np.uint32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, before, counts = TaskContext.get().partitionId(), 0, 0, _Counts()
        ids, docs, lengths, size = [], [], [], 0

        def row():
            whole = np.concatenate(ids)
            counts.add(whole)
            null = np.array([d is None for d in docs], bool)
            return pd.DataFrame({
                "range": [part], "block": [number], "before": [before], "n": [len(whole)], "nulls": [null.tobytes()],
                "doc_ids": [np.array([d or 0 for d in docs], "<i8").tobytes()], "lengths": [np.array(lengths, "<u4").tobytes()],
                "ids": [whole.astype("<u4", copy=False).tobytes()],
            })

        for batch in batches:
            names = [None if pd.isna(d) else int(d) for d in batch["doc_id"]]
            for doc, got in zip(names, encoder(path).ids(batch["text"]), strict=True):
                ids += [got, tail]
                docs.append(doc)
                lengths.append(len(got) + 1)
                size += len(got) + 1
                if size >= BLOCK:
                    yield row()
                    number, before = number + 1, before + size
                    ids, docs, lengths, size = [], [], [], 0
        if docs:
            yield row()
        tokens, n = counts.rows()
        yield pd.DataFrame({
            "range": [part], "block": [-1], "before": [0], "n": [0], "nulls": [b""], "doc_ids": [tokens], "lengths": [n], "ids": [b""],
        })

    return run


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for tokens, n in zip(batch["doc_ids"], batch["lengths"], strict=True):
            yield pd.DataFrame({"token": np.frombuffer(tokens, "<i8"), "n": np.frombuffer(n, "<i8")})


def _coder(freq: dict[int, int]):
    listed = _listed(freq)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table.of(*listed)
        for batch in batches:
            for _, r in batch.iterrows():
                ids, null, lengths = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["nulls"], "u1"), np.frombuffer(r["lengths"], "<u4")
                names = np.frombuffer(r["doc_ids"], "<i8")
                payload = encode(ids, names, null, lengths, table)
                yield pd.DataFrame({
                    "range": [r["range"]], "block": [r["block"]], "first_token": [r["first_token"]], "n_docs": [len(names)],
                    "n_tokens": [len(ids)], "payload": [payload], "crc32": [zlib.crc32(payload)],
                })

    return run


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text) and write ``table`` and ``blocks`` below ``folder``.

    Texts are shuffled once, by ranges of doc_id. What comes to the driver is one total per range and
    one count per distinct token, which the vocabulary bounds.
    """
    spark = docs.sparkSession
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    coded = stored(ordered.mapInPandas(
        _blocks_of(tokenizer_path, end_id),
        "range int, block int, before bigint, n bigint, nulls binary, doc_ids binary, lengths binary, ids binary",
    ), "token-blocks")
    raw = coded.filter("block >= 0")
    tallies = coded.filter("block < 0").select("doc_ids", "lengths")
    counts = tallies.mapInPandas(_counts, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).collect()
    freq = scaled({r["token"]: r["n"] for r in counts}) if counts else {}
    spark.createDataFrame(sorted(freq.items()), "token bigint, frequency bigint").coalesce(1).write.parquet(f"{folder}/table")
    totals = raw.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect()
    starts, running = [], 0
    for r in totals:
        starts.append((r["range"], running))
        running += r["n"]
    # one row per range: bounded by the number of shuffle partitions
    offsets = F.broadcast(spark.createDataFrame(starts, "range int, offset bigint"))
    placed = raw.join(offsets, "range").withColumn("first_token", F.col("before") + F.col("offset")).drop("before", "n", "offset")
    placed.mapInPandas(
        _coder(freq), "range int, block int, first_token bigint, n_docs int, n_tokens bigint, payload binary, crc32 bigint"
    ).write.parquet(f"{folder}/blocks")


def _reader(freq: dict[int, int]):
    listed = _listed(freq)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = Table.of(*listed)
        for batch in batches:
            for payload, crc, first in zip(batch["payload"], batch["crc32"], batch["first_token"], strict=True):
                if zlib.crc32(payload) != crc:
                    raise ValueError("a block does not have its checksum")
                block = Block(payload)
                ids = block.decode(table).astype("<u4")
                ends = np.cumsum(block.lengths)
                yield pd.DataFrame({
                    "doc_id": pd.array(block.doc_ids, dtype="Int64"), "start": first + ends - block.lengths, "n_tokens": block.lengths,
                    "ids": [ids[e - k:e].tobytes() for e, k in zip(ends, block.lengths, strict=True)],
                })

    return run


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a data set: doc_id, start, n_tokens, ids (little-endian uint32)."""
    freq = {r["token"]: r["frequency"] for r in spark.read.parquet(f"{folder}/table").collect()}
    blocks = spark.read.parquet(f"{folder}/blocks").select("payload", "crc32", "first_token")
    return blocks.mapInPandas(_reader(freq), "doc_id bigint, start bigint, n_tokens bigint, ids binary")
