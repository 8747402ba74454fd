"""Message topics: Kafka where its connector is on the classpath, otherwise folders of Parquet files
with the same columns (``<root>/batch_id=<n>/topic=<name>/``)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from .. import schemas
from . import tables

RAW_TOPIC = "iot_raw_logs"
ALERT_TOPIC = "iot_pipeline_alerts"
FILES_PER_TRIGGER = 512
MAX_BYTES = 1_000_000  # what a broker takes by default


def kafka_read_options(servers: str, topics: list[str], per_trigger: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": "earliest"}
    return options | ({"maxOffsetsPerTrigger": str(per_trigger)} if per_trigger else {})


def kafka_write_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all"}


def from_kafka(spark: SparkSession, servers: str, topics: list[str], per_trigger: int | None = None) -> DataFrame:
    """Streaming frame with the columns of a topic folder; the position is offset, partition and topic in one number."""
    source = spark.readStream.format("kafka").options(**kafka_read_options(servers, topics, per_trigger)).load()
    return source.select(
        _kafka_position(topics).alias("position"),
        F.col("key").cast("string").alias("key"), "value", "topic",
    )


def _kafka_position(topics: list[str]) -> Column:
    """Offset first, so that it sorts by age; partitions and topics of equal offsets stay apart."""
    place = F.array_position(F.array(*map(F.lit, topics)), F.col("topic"))
    number = F.col("offset").cast(schemas.POSITION) * F.lit(2**31) + F.col("partition")
    return (number * F.lit(len(topics) + 1) + place).cast(schemas.POSITION)


def stream(spark: SparkSession, root: str, topics: list[str], files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Streaming frame over a topic folder, limited to some topics.

    A micro-batch takes a bounded number of files, also when a job drains a long backlog.
    """
    reader = spark.readStream.schema(schemas.TOPIC).option("maxFilesPerTrigger", files_per_trigger)
    return _subscribed(reader.parquet(root), topics)


def read(spark: SparkSession, root: str, topics: list[str]) -> DataFrame:
    """Everything in a topic folder, as a batch frame."""
    return _subscribed(spark.read.schema(schemas.TOPIC).parquet(root), topics)


def _subscribed(df: DataFrame, topics: list[str]) -> DataFrame:
    return df.filter(F.col("topic").isin(*topics)).select("position", "key", "value", "topic")


def position(batch_id: int = 0) -> Column:
    """A number no other row of this or another batch gets: the batch number above Spark's own 64-bit
    row number, which stays as it is. It sorts by batch, then task, then row."""
    base = F.lit(Decimal(batch_id * 2**63)).cast(schemas.POSITION)
    return (base + F.monotonically_increasing_id().cast(schemas.POSITION)).cast(schemas.POSITION)


def publish(messages: DataFrame, root: str, topic: str, batch_id: int = 0, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Write keyed messages to one topic; returns a one-row frame: sent, failed.

    A message larger than the topic takes (or without a value) is refused, and the others still go. What was sent is
    read back from the topic; ``failed`` is what was offered and is not there.
    """
    spark, offered = messages.sparkSession, Observation()
    numbered = messages if "position" in messages.columns else messages.withColumn("position", position(batch_id))
    out = numbered.select(F.col("position").cast(schemas.POSITION).alias("position"), "key", "value", F.lit(topic).alias("topic"))
    size = F.octet_length("value") + F.coalesce(F.octet_length("key"), F.lit(0))
    folder = f"{root}/batch_id={batch_id}"
    taken = out.observe(offered, F.count(F.lit(1)).alias("messages")).filter(size <= max_bytes)
    taken.write.mode("overwrite").partitionBy("topic").parquet(folder)
    visible = spark.read.schema(schemas.TOPIC).parquet(folder).filter(F.col("topic") == topic)
    return visible.agg(F.count(F.lit(1)).alias("sent")).select("sent", (F.lit(offered.get["messages"]) - F.col("sent")).alias("failed"))


def read_range(messages: DataFrame, committed: DataFrame, max_messages: int = 0) -> tuple[DataFrame, DataFrame]:
    """A bounded read of (topic, partition, offset, ...) after ``committed`` (topic, partition, next_offset).

    Returns the messages and the offsets to commit, from which the next read goes on. Partitions without a committed
    offset start at their first message; with ``max_messages`` (0: no bound) the read takes that many offsets,
    partition after partition in order of topic and partition. Offsets are counted, not messages, so a read never
    takes more. The offsets are one row for each partition; messages are filtered and not shuffled.
    """
    place = ["topic", "partition"]
    start = F.coalesce("next_offset", F.col("low"))
    ends = messages.groupBy(*place).agg(F.min("offset").alias("low"), F.max("offset").alias("high")).join(
        committed.select(*place, "next_offset"), place, "left"
    ).select(*place, F.greatest(start, F.col("low")).alias("from"), (F.col("high") + 1).alias("until")).withColumn(
        "ready", F.greatest(F.col("until") - F.col("from"), F.lit(0))
    )
    earlier = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    left = F.lit(max_messages) - F.coalesce(F.sum("ready").over(earlier), F.lit(0))
    quota = F.greatest(F.least(F.col("ready"), left), F.lit(0)) if max_messages else F.col("ready")
    planned = ends.withColumn("stop", F.col("from") + quota).select(*place, "from", "stop")
    # partitions of a topic, not messages: a broker's topics have thousands at most
    taken = messages.join(planned, place).filter((F.col("offset") >= F.col("from")) & (F.col("offset") < F.col("stop"))).select(*messages.columns)
    return taken, planned.filter(F.col("stop") > F.col("from")).select(*place, F.col("stop").alias("next_offset"))


def commit_offsets(offsets: DataFrame, root: str, group: str) -> None:
    """Add the offsets a consumer group has read up to; called after the messages are stored."""
    rows = offsets.select(F.lit(group).alias("group_id"), "topic", F.col("partition").cast("bigint").alias("partition"), F.col("next_offset").cast("bigint").alias("next_offset"))
    rows.write.mode("append").parquet(f"{root}/_offsets")


def committed_offsets(spark: SparkSession, root: str, group: str) -> DataFrame:
    """Where a consumer group goes on: topic, partition, next_offset. Offsets only grow, so the largest counts."""
    if not tables.exists(spark, f"{root}/_offsets"):
        return spark.createDataFrame([], schemas.OFFSETS).drop("group_id")
    stored = spark.read.schema(schemas.OFFSETS).parquet(f"{root}/_offsets").filter(F.col("group_id") == group)
    return stored.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))
