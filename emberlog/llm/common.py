"""Helpers the corpus operators share: stored intermediate tables, positions in a global order, word bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from xxhash import xxh64_intdigest

from ..session import prepare, scratch_dir
from .skew import hot_keys, salted_join


ROWS_PER_BATCH = 500


def settle(spark: SparkSession) -> SparkSession:
    """The session settings of the package, and small Arrow batches: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return prepare(spark)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below ``spark.checkpoint.dir`` and read it back.

    The files cut the lineage: a lost executor costs the tasks that read them, not the work before.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark, label)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def positions(df: DataFrame, keys: list[str], weights: dict[str, str] | None = None, label: str = "order") -> DataFrame:
    """Global position of every row in ascending order of ``keys``, and running sums before it.

    Adds ``rank`` (from 0) and, for each ``name: column`` of ``weights``, ``name`` as the sum of
    that column over all earlier rows. Rows are dealt out by ranges of the keys, each range is
    numbered by itself, and only one total per range comes to the driver. Nulls sort first. Rows
    equal in all keys get different positions in any order, so callers name every column that
    tells rows apart. Keep the frame narrow: it is shuffled and stored once.
    """
    weights = weights or {}
    spark = df.sparkSession
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged, label)
    sums = [F.sum(column).alias(name) for name, column in weights.items()]
    totals = sorted(ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("rank"), *sums).collect())
    starts, running = [], [0] * (1 + len(weights))
    for total in totals:
        starts.append((total[0], *running))
        running = [a + (b or 0) for a, b in zip(running, total[1:], strict=True)]
    schema = ", ".join(["_range int", "_rank bigint", *[f"`_{name}` bigint" for name in weights]])
    offsets = spark.createDataFrame(starts, schema)
    within = Window.partitionBy("_range").orderBy(*keys)
    earlier = within.rowsBetween(Window.unboundedPreceding, -1)
    numbered = ranged.select(
        "*", (F.row_number().over(within) - 1).cast("bigint").alias("rank"),
        *[F.coalesce(F.sum(column).over(earlier), F.lit(0)).cast("bigint").alias(name) for name, column in weights.items()],
    )
    # one row per range: bounded by the number of shuffle partitions
    numbered = numbered.join(F.broadcast(offsets), "_range")
    return numbered.select(
        *df.columns, *[(F.col(name) + F.col(f"_{name}")).alias(name) for name in ("rank", *weights)]
    )


def byte_table(keep) -> bytes:
    """A translation table for ASCII: letters to lower case, kept bytes as they are, the rest a space.

    Bytes from 128 on belong to letters outside ASCII and are kept.
    """
    return bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or keep(b) else 32 for b in range(256))


# words of digits, letters a-z and anything outside ASCII
WORD_BYTES = byte_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122)


def doc_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that name a document by doc_id and whole text; rows equal in both are one document."""
    parts = (F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


PREFIX_BITS = 20


def _prefix(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - PREFIX_BITS)


def near_keys(docs: DataFrame, keys: DataFrame, other: bool = False) -> DataFrame:
    """Rows of ``docs`` whose doc_key may be among ``keys`` (or, with ``other``, those where it cannot be).

    Both have a column doc_key. Rows are told apart by PREFIX_BITS bits of a hash, so the broadcast side
    has at most 2**PREFIX_BITS rows however many keys there are, and texts that no key can name do not
    have to be shuffled. The exact join follows.
    """
    wanted = F.broadcast(keys.select(_prefix(F.col("doc_key")).alias("_prefix")).distinct())
    marked = docs.withColumn("_prefix", _prefix(F.col("doc_key")))
    return marked.join(wanted, "_prefix", "left_anti" if other else "left_semi").drop("_prefix")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of an undirected graph (a, b): node, root (the smallest node reachable).

    Alternates two steps until nothing changes: every node points its larger neighbours to the smallest
    node it knows, then every node and its smaller neighbours point to the smallest of them. Each round
    is a few joins over stored edges, and only a count and a checksum come to the driver.
    """
    edges = edges.filter(F.col("a") != F.col("b"))
    pairs = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), label)
    state = None
    while True:
        both = pairs.union(pairs.select("v", "u"))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n")), label)
        # a node with many neighbours, such as the smallest of a large family, is dealt over many tasks
        hot = hot_keys(least, ["u"], "n", least.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        wide = salted_join(both.filter(F.col("v") > F.col("u")), least.drop("n"), ["u"], hot)
        large = wide.select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter(F.col("u") != F.col("v")).distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").filter(F.col("u") != F.col("v")).distinct()
        pairs = stored(small, label)
        row = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("check")).first()
        if (row["n"], row["check"]) == state:
            break
        state = (row["n"], row["check"])
    roots = pairs.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


_HASHES: dict[bytes, int] = {}
REMEMBERED_WORDS = 100_000  # about 10 MB in each worker
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words; each worker remembers a bounded number of them."""
    if len(_HASHES) > REMEMBERED_WORDS:
        _HASHES.clear()
    for word in set(words):
        if word not in _HASHES:
            _HASHES[word] = xxh64_intdigest(word)
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Hash of every run of ``width`` words in order; of the whole sequence if there are fewer words."""
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    width = min(width, len(h))
    total = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        total += h[k:len(h) - width + 1 + k] * np.uint64(_MULTIPLIERS[k])
    return mixed(total + np.uint64(width))
