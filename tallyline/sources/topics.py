"""Reading JSON messages from a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    offsets: str = "latest",
    messages_per_batch: int | None = None,
) -> DataFrame:
    """Subscribe to a Kafka topic. Needs Spark's Kafka package on the classpath.

    `messages_per_batch` bounds a batch when a job has fallen behind.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
    )
    if messages_per_batch:
        reader = reader.option("maxOffsetsPerTrigger", messages_per_batch)
    return reader.load()


def read_topic_files(
    spark: SparkSession, directory: str, files_per_batch: int | None = None
) -> DataFrame:
    """Text files standing in for a topic: the same binary `value` column."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(directory).select(F.col("value").cast("binary").alias("value"))


def payload_text(messages: DataFrame) -> DataFrame:
    """The message bytes as text."""
    return messages.select(F.col("value").cast("string").alias("json"))


def parse_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """One column per field. A malformed message becomes a row of nulls."""
    return payload_text(messages).select(F.from_json("json", schema).alias("m")).select("m.*")


def split_malformed(parsed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without) for those who want a dead-letter table."""
    return parsed.where(F.col(key).isNotNull()), parsed.where(F.col(key).isNull())
