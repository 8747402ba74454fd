"""Sharding: contiguous shards of documents whose largest shard is as small as it can be.

Documents with equal text form an atomic group. Groups keep corpus order (the smallest doc_id of a
group, then its text digest), and shards are cut between groups so that the largest shard has the
smallest capacity that is feasible. The capacity is found by binary search with a greedy check.

Only group boundaries that can matter come to the driver: first at most BOUNDARIES evenly spaced
ones, then, round by round, finer ones inside the stretches where a greedy cut may fall, until every
cut is at an exact group boundary. What the driver holds does not grow with the corpus.

Defined cases: a null text counts as empty text and groups with empty ones (size 1 a row); a null
doc_id sorts first; repeated rows stay rows of their own in one group; an empty table gives an empty
result; a group larger than a fair share fixes the capacity and the other shards share the rest;
with fewer groups than shards some shards stay empty. Other columns are carried through untouched.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .common import positions, stored, utf8_size

BOUNDARIES = 4096
SPLIT = 64


@dataclass
class Cuts:
    """Where shards begin, by size before the group, and the capacity that was found."""

    starts: list[int]
    capacity: int


class Blocks:
    """Consecutive runs of groups: size before each run, and its number of groups (1 means exact)."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        self.rows = sorted(rows)  # (size before, size after, first rank, groups)
        self.before = [r[0] for r in self.rows]
        self.after = [r[1] for r in self.rows]
        self.total = self.after[-1] if self.rows else 0

    def last_cut(self, at: int) -> tuple[int, int, int | None]:
        """(known boundary at or before ``at``, furthest place a real one may be, open block)."""
        if at >= self.total:
            return self.total, self.total, None
        k = bisect_right(self.before, at) - 1
        low, high, _, groups = self.rows[k]
        return (low, low, None) if groups == 1 or at == low else (low, min(at, high - 1), k)

    def next_cut(self, at: int) -> tuple[int, int | None]:
        """(known boundary at or after ``at``, open block in which an earlier one may be)."""
        k = bisect_left(self.before, at)
        high = self.before[k] if k < len(self.before) else self.total
        inside = k - 1 if k and high != at and self.rows[k - 1][3] > 1 else None
        return high, inside


def greedy(blocks: Blocks, capacity: int, shards: int, start: int = 0, hopeful: bool = False) -> tuple[bool, set[int]]:
    """Whether ``shards`` shards of a capacity hold all from ``start`` on, and the open blocks met."""
    met: set[int] = set()
    at = start
    for _ in range(shards):
        sure, maybe, block = blocks.last_cut(at + capacity)
        met |= set() if block is None else {block}
        step = maybe if hopeful else sure
        if step >= blocks.total:
            return True, met
        if step <= at:
            return False, met
        at = step
    return at >= blocks.total, met


def smallest(feasible, low: int, high: int) -> int:
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low


def level(blocks: Blocks, capacity: int, shards: int) -> tuple[list[int], set[int]]:
    """Cuts within a feasible capacity, each as near as can be to an equal share of what is left."""
    starts, met, at = [0], set(), 0
    for left in range(shards, 1, -1):
        fair = at + -(-(blocks.total - at) // left)
        ahead, inside = blocks.next_cut(fair)
        behind, _, block = blocks.last_cut(fair)
        furthest, _, far = blocks.last_cut(at + capacity)
        met |= {b for b in (inside, block, far) if b is not None}
        choices = [c for c in sorted({ahead, behind}, key=lambda c: (abs(c - fair), c)) if at <= c <= at + capacity]
        for choice in [*choices, furthest]:
            done, seen = greedy(blocks, capacity, left - 1, choice)
            met |= seen
            if done:
                break
        at = choice
        starts.append(at)
    return starts, met


def cut(groups: DataFrame, shards: int) -> Cuts:
    """The minimax cuts over ``groups`` (rank, before, size)."""
    span = groups.agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("most")).first()
    if not span["n"]:
        return Cuts([0] * shards, 0)

    def collected(rows: DataFrame, run) -> list[tuple[int, int, int, int]]:
        got = rows.groupBy(run.alias("run")).agg(
            F.min("before"), F.max(F.col("before") + F.col("size")), F.min("rank"), F.count(F.lit(1))
        )
        return [tuple(r)[1:] for r in got.collect()]

    width = -(-span["n"] // BOUNDARIES)
    blocks = Blocks(collected(groups, F.floor(F.col("rank") / width)))
    while True:
        floor = max(-(-blocks.total // shards), span["most"])
        sure = smallest(lambda c: greedy(blocks, c, shards)[0], floor, blocks.total)
        hope = smallest(lambda c: greedy(blocks, c, shards, hopeful=True)[0], floor, sure)
        if hope < sure:
            met = greedy(blocks, sure, shards)[1] | greedy(blocks, hope, shards, hopeful=True)[1]
            met |= greedy(blocks, sure - 1, shards)[1]
        else:
            starts, met = level(blocks, sure, shards)
            if not met:
                return Cuts(starts, sure)
        open_blocks = [blocks.rows[k] for k in sorted(met)]
        wanted, run = F.lit(False), F.lit(None).cast("bigint")
        for k, (_, _, first, n) in enumerate(open_blocks):
            here = F.col("rank").between(first, first + n - 1)
            step = -(-n // SPLIT)
            wanted = wanted | here
            run = F.when(here, k * 2 * SPLIT + F.floor((F.col("rank") - first) / step)).otherwise(run)
        finer = collected(groups.filter(wanted), run)
        blocks = Blocks([r for k, r in enumerate(blocks.rows) if k not in met] + finer)


def shard(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Assign every row of ``docs`` (doc_id, text) to a shard; returns one narrow row for each.

    Columns: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, digest, shard, slot (place
    in the shard from 0, in corpus order). The text does not pass a shuffle.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = stored(docs.select(
        "doc_id", (utf8_size(F.col("text")) + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    ), "shard-rows")
    # summed before the shuffle: a group that holds a third of all rows sends one row per task
    groups = narrow.groupBy("digest").agg(
        F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("first_id"), F.sum("size").alias("size")
    )
    ordered = stored(positions(groups, ["first_id", "digest"], {"before": "size"}, "shard-groups"), "shard-order")
    starts = cut(ordered.select("rank", "before", "size"), shards).starts
    number = sum((F.when(F.col("before") >= s, 1).otherwise(0) for s in starts[1:]), F.lit(0)).cast("int")
    # an empty shard begins where the next one does: the later number wins, numbers in between stay unused
    owner = ordered.select("digest", F.col("rank").alias("group_rank"), number.alias("shard"))
    placed = narrow.join(owner, "digest")
    ranked = positions(placed, ["group_rank", "doc_id", "text_crc32", "size", "digest", "shard"], label="shard-slots")
    first = {r["shard"]: r["rank"] for r in ranked.groupBy("shard").agg(F.min("rank").alias("rank")).collect()}
    begin = F.coalesce(*[F.when(F.col("shard") == s, F.lit(r)) for s, r in first.items()], F.lit(0))
    return ranked.select("doc_id", "size", "text_crc32", "digest", "shard", (F.col("rank") - begin).cast("bigint").alias("slot"))
