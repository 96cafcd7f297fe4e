"""Event streams: raw messages in, keyed JSON messages out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType, TimestampType

# What a Kafka record offers and a file of messages has as well.
MESSAGE_SCHEMA = StructType(
    [
        StructField("key", StringType()),
        StructField("value", BinaryType()),
        StructField("timestamp", TimestampType()),
        StructField("message_id", StringType()),
    ]
)


def event_source(
    spark: SparkSession,
    path: str | None = None,
    brokers: str | None = None,
    topic: str = "crime_events",
    starting: str = "latest",
    max_per_batch: int | None = None,
    **options: str,
) -> DataFrame:
    """A stream of raw messages: key, value (bytes), timestamp, message_id.

    With ``brokers`` it reads a Kafka topic; the offsets live in the checkpoint of the
    query, so a restart goes on where it stopped and ``starting`` counts only the first
    time. With ``path`` it reads Parquet files of messages as they arrive.
    """
    if brokers is not None:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", brokers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .options(**options)
        )
        if max_per_batch:
            reader = reader.option("maxOffsetsPerTrigger", max_per_batch)
        return reader.load().select(
            F.col("key").cast("string").alias("key"),
            "value",
            "timestamp",
            # Padded, so that the text order within a partition is the offset order.
            F.format_string(
                "%s-%06d-%020d", F.col("topic"), F.col("partition"), F.col("offset")
            ).alias("message_id"),
        )
    if path is None:
        raise ValueError("give brokers or a path")
    reader = spark.readStream.schema(MESSAGE_SCHEMA).options(**options)
    if max_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_per_batch)
    return reader.parquet(path)


def write_messages(messages: DataFrame, brokers: str, topic: str = "crime_events") -> None:
    """Publish keyed messages to a Kafka topic; Spark retries failed tasks."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )
