"""Writing tables and publishing records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Write Parquet and return the number of rows, counted while writing.

    For partitioned tables rows are rebalanced by partition value first: few
    files per directory, and a partition holding many rows is split over
    several tasks. `finish` makes of the rows what is written, in the writing
    tasks: what it adds is not shuffled.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if finish:
        df = finish(df)
    # Observed in the writing tasks, each of which counts once however often
    # lost tasks before them run again.
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["n"]


def as_messages(df: DataFrame, key_column: str | None = None) -> DataFrame:
    """Each row as a JSON message; null fields are kept as JSON nulls."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    if key_column is None:
        return df.select(value)
    return df.select(F.col(key_column).cast("string").alias("key"), value)


def publish_json(
    df: DataFrame,
    topic: str | None = None,
    servers: str | None = None,
    directory: str | None = None,
    key_column: str | None = None,
) -> None:
    """Send rows as JSON to a Kafka topic, or to text files standing in for one.

    The Kafka form needs Spark's Kafka package on the classpath.
    """
    if directory is not None:
        as_messages(df).write.mode("append").text(directory)
        return
    (
        as_messages(df, key_column)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
