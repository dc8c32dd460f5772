"""Streams that keep state: deduplication, pairing of two topics, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.kpis import ops_index


def dedupe_stream(
    df: DataFrame,
    key: str = "transaction_id",
    time: str = "event_time",
    delay: str = "1 hour",
    salts: int = 1,
) -> DataFrame:
    """One row per key within the watermark; state is dropped behind it.

    Rows without a key are malformed messages, not copies of each other; they are
    left out here and reach their own sink by `split_malformed`. With `salts`
    above 1 a key sent very often is first thinned out in so many slices, for
    twice the state, and the task that owns it sees a few rows of it per batch.
    """
    df = df.where(F.col(key).isNotNull())
    if salts > 1:
        # Copies are equal, so no column can tell them apart; any spread gives
        # the same answer.
        spread = df.withColumn("__salt", F.floor(F.rand(17) * salts))
        thinned = spread.withWatermark(time, delay).dropDuplicatesWithinWatermark([key, "__salt"])
        return thinned.drop("__salt").dropDuplicatesWithinWatermark([key])
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def pair_streams(
    transactions: DataFrame,
    signals: DataFrame,
    within: str = "1 hour",
    delay: str = "1 hour",
) -> DataFrame:
    """Transactions with the signals inferred at most `within` later.

    A transaction without one is emitted once the watermark has passed it.
    """
    t = transactions.withWatermark("event_time", delay)
    s = signals.withWatermark("inference_time", delay).withColumnRenamed(
        "transaction_id", "signal_transaction_id"
    )
    close = F.expr(
        "transaction_id = signal_transaction_id AND inference_time >= event_time "
        f"AND inference_time <= event_time + INTERVAL {within}"
    )
    return t.join(s, close, "leftOuter").drop("signal_transaction_id")


def ops_stream(
    events: DataFrame, is_error: Column, time: str = "event_time", delay: str = "1 hour",
    size: str = "5 minutes", slide: str | None = None,
) -> DataFrame:
    """Throughput and error rate per window; a window is emitted when it closes."""
    return ops_index(events.withWatermark(time, delay), time, is_error, size=size, slide=slide)
