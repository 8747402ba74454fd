"""First-N by counting against plain sorting, also with keys that pile up on one value."""

import pytest
from pyspark.sql import functions as F

from emberlog.functions import ordering
from emberlog.operators import sampling


@pytest.fixture(scope="module")
def skewed(spark):
    # a third of the rows share one key; ids are unique
    return spark.range(30000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 500).otherwise((F.col("id") * 7919) % 100003 - 50000).alias("k")
    ).repartition(7).persist()


@pytest.mark.parametrize("n", [999, 14000, 30000])
def test_counted_cut_equals_sort(skewed, n, monkeypatch):
    monkeypatch.setattr(ordering, "BUCKETS", 64)
    keys = [F.col("k"), -F.col("id")]
    counted = ordering.first_rows(skewed, keys, n)
    sorted_ = skewed.orderBy(*keys).limit(n)
    assert counted.count() == min(n, 30000)
    assert counted.exceptAll(sorted_).isEmpty()


def test_rows_that_share_all_keys(spark):
    df = spark.range(1000).select(F.lit(5).alias("k"))
    assert ordering.first_rows(df, [F.col("k")], 300).count() == 300


def test_newest_first_puts_missing_times_last(spark):
    df = spark.createDataFrame([(1, None), (2, "2025-01-01"), (3, "2025-01-02"), (4, "2025-01-02")], "id bigint, t string")
    df = df.withColumn("t", F.col("t").cast("timestamp"))
    for rows_of in (ordering.top_rows, ordering.first_rows):
        rows = rows_of(df, ordering.newest_first(F.col("t"), F.col("id")), 3).collect()
        assert {r["id"] for r in rows} == {2, 3, 4}


def test_row_numbers_over_many_splits(spark, folder):
    lines = 20000
    with open(f"{folder}/a.csv", "w") as out:
        out.write("x\n" + "".join(f"v{i:06d}\n" for i in range(lines)))
    with open(f"{folder}/b.csv", "w") as out:
        out.write("x\n" + "".join(f"w{i:06d}\n" for i in range(100)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scanned = spark.read.csv(folder, schema="x string", header=True).select(
            "x", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_seq"),
        )
        assert scanned.rdd.getNumPartitions() > 4
        wrong = ordering.number_rows(scanned, first=2).filter(F.col("row_number") != F.substring("x", 2, 6).cast("int") + 2)
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_random_subset(spark):
    df = spark.range(20000)
    one, two = (sampling.random_n(df, ["id"], 5000, seed=s) for s in (1, 2))
    assert one.count() == 5000 and one.distinct().count() == 5000
    assert sampling.random_n(df.repartition(3), ["id"], 5000, seed=1).exceptAll(one).isEmpty()
    # uniform: each fifth of the ids gets about a fifth of the sample, and seeds differ
    shares = [r["count"] for r in one.groupBy(F.floor(F.col("id") / 4000)).count().collect()]
    assert all(880 <= s <= 1120 for s in shares)
    assert 1000 < one.intersect(two).count() < 1500
    assert sampling.random_n(df, ["id"], 10**6).count() == 20000
