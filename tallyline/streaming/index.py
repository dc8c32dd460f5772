"""Streaming indexes: topic to typed rows to an append-only Parquet table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.skew import fits_broadcast
from ..schemas import FRAUD_SIGNAL, STREAM_TRANSACTION
from ..sources.topics import parse_messages


def build_stream_index(
    messages: DataFrame, schema: T.StructType = STREAM_TRANSACTION
) -> DataFrame:
    """Transactions from messages, stamped with the time they were processed."""
    return parse_messages(messages, schema).withColumn("processed_at", F.current_timestamp())


def enrich_stream(
    messages: DataFrame, transactions: DataFrame, schema: T.StructType = FRAUD_SIGNAL
) -> DataFrame:
    """Fraud signals from messages, left-joined to the static transactions.

    A small table is sent to all tasks; a large one is joined by shuffle, and
    AQE splits the partitions of hot transactions in every batch.
    """
    if fits_broadcast(transactions):
        transactions = F.broadcast(transactions)
    return parse_messages(messages, schema).join(transactions, "transaction_id", "left")


def start_index(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append to a Parquet table, exactly once per message across restarts.

    `trigger` is {"processingTime": "5 seconds"} or {"availableNow": True};
    without it batches follow one another at once.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def drain(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process everything available now, stop, and read the table back."""
    start_index(df, path, checkpoint, {"availableNow": True}).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def transaction_index_job(
    messages: DataFrame, path: str, checkpoint: str, every: str = "5 seconds"
) -> StreamingQuery:
    """The running job over the transactions topic."""
    return start_index(
        build_stream_index(messages), path, checkpoint, {"processingTime": every}
    )


def signal_index_job(
    spark: SparkSession, messages: DataFrame, transactions: DataFrame, path: str, checkpoint: str
) -> StreamingQuery:
    """The running job over the fraud-signals topic, at the default trigger."""
    return start_index(enrich_stream(messages, transactions), path, checkpoint)


def enrich_batches(
    rows: DataFrame,
    lookup: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    key: str = "transaction_id",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Left-join each batch to a table that changes while the stream runs.

    `lookup` is called once a batch with the batch's keys and returns the rows of
    those keys as they are then; nothing of the table is read at the start. A batch
    writes its own folder, over what an earlier attempt of it may have left, so
    each row is written once across restarts. Null keys find nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        keys = batch.select(key).where(F.col(key).isNotNull()).distinct()
        joined = batch.join(lookup(keys), key, "left")
        joined.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
