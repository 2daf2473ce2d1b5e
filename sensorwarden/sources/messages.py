"""Message sources: files, tables, Kafka topics; batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwarden.functions.topics import TOPIC_ALERT, TOPIC_DATA, topic_matches, usable_message
from sensorwarden.schemas import RAW_MESSAGE


def read_messages(spark: SparkSession, path: str, fmt: str = "json", stream: bool = False, **options) -> DataFrame:
    """Landed messages (JSON lines or Parquet) with the raw message schema."""
    reader = spark.readStream if stream else spark.read
    return reader.format(fmt).schema(RAW_MESSAGE).options(**options).load(path)


def read_kafka(spark: SparkSession, servers: str, topics: str, stream: bool = True, **options) -> DataFrame:
    """Messages bridged to Kafka: record key = message topic, value = payload, offset = arrival order.

    Offsets order one partition only: key the records by device so that a node stays in one partition,
    and the per-node order (all the rules need) is the offset order.
    """
    reader = spark.readStream if stream else spark.read
    records = (
        reader.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics).options(**options).load()
    )
    return from_kafka(records)


#: Topic partitions whose messages still get a seq of their own.
MAX_PARTITIONS = 65536


def from_kafka(records: DataFrame) -> DataFrame:
    # partition number in the low bits keeps seq unique without changing the order inside a partition
    seq = F.col("offset") * MAX_PARTITIONS + F.col("partition")
    too_many = F.raise_error(F.lit(f"a topic with more than {MAX_PARTITIONS} partitions would repeat seq values"))
    return records.select(
        F.when(F.col("partition") < MAX_PARTITIONS, seq).otherwise(too_many.cast("bigint")).alias("seq"),
        F.col("key").cast("string").alias("topic"),
        F.col("value").cast("string").alias("payload"),
        F.lit(False).alias("retain"),
        F.unix_seconds("timestamp").alias("received_at"),
    )


def spread(raw: DataFrame) -> DataFrame:
    """Messages dealt to all cores where their source has fewer splits than that: parsing is work for processors.

    A source of many files or splits is left alone, so this never shuffles a large table.
    """
    cores = raw.sparkSession.sparkContext.defaultParallelism
    return raw if raw.rdd.getNumPartitions() >= cores else raw.repartition(cores)


def counted(raw: DataFrame, alerts: bool = False) -> DataFrame:
    """Subscribed, usable messages - the ones that are counted as received."""
    filters = (TOPIC_DATA, TOPIC_ALERT) if alerts else (TOPIC_DATA,)
    topic = F.col("topic")
    return raw.filter(topic_matches(topic, *filters) & usable_message(topic, F.col("payload"), F.col("retain")))


def named(raw: DataFrame) -> DataFrame:
    """Node named in each payload, read without the full parse.

    Good enough to find the nodes with many messages: which nodes are cut into spans never changes a result.
    """
    return raw.select("seq", F.get_json_object("payload", "$.node_id").alias("node_id"))
