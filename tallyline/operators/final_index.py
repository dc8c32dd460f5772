"""The final, one-table view: joined chain or merged indexes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .latest import latest_per_key
from .matching import stamp_run
from .skew import HotKeys, hot_keys, skew_join

# Columns of the final index, in order.
FINAL_COLUMNS = [
    "transaction_id",
    "merchant_id",
    "user_id",
    "amount",
    "currency",
    "status",
    "discrepancy",
    "reconciliation_status",
    "fraud_signal_id",
    "fraud_score",
    "inference_time",
    "processed_at",
    "final_index_ts",
]


def build_final_index(
    batch_index: DataFrame,
    signals: DataFrame,
    stream_index: DataFrame,
    run_ts: str,
    dedupe: bool = False,
) -> DataFrame:
    """Batch index with fraud signals and the time the stream saw each transaction.

    Several signals or stream rows per transaction give several rows, unless
    `dedupe` keeps the latest of each.
    """
    batch = batch_index.select(
        "transaction_id", "merchant_id", "user_id", "amount", "currency", "status",
        "discrepancy", "reconciliation_status",
    )
    signals = signals.select(
        "transaction_id", "fraud_signal_id", "fraud_score", "inference_time"
    )
    seen = stream_index.select("transaction_id", "processed_at")
    if dedupe:
        signals = latest_per_key(
            signals, ["transaction_id"], ["inference_time"], ["fraud_signal_id"]
        )
        seen = seen.groupBy("transaction_id").agg(F.max("processed_at").alias("processed_at"))
    key = "transaction_id"
    hot_batch = hot_keys(batch, key)
    hot_signals = HotKeys() if dedupe else hot_keys(signals.where(F.col(key).isNotNull()), key)
    out = skew_join(
        batch, signals, key, "left", unique_right=dedupe, hot_left=hot_batch, hot_right=hot_signals
    )
    out = skew_join(
        out, seen, key, "left", unique_right=dedupe, hot_left=hot_batch.joined_with(hot_signals)
    )
    return stamp_run(out, run_ts, "final_index_ts").select(*FINAL_COLUMNS)


def extend_for_reports(
    final_index: DataFrame, transactions: DataFrame, flags: DataFrame, payouts: DataFrame
) -> DataFrame:
    """Add what the reports also read: event time, risk label and payout date.

    `transactions` needs event_time and `payouts` payout_due_date, of which the
    highest per transaction counts; `flags` has one row per transaction.
    """
    key = "transaction_id"
    times = transactions.groupBy(key).agg(F.max("event_time").alias("event_time"))
    due = payouts.groupBy(key).agg(F.max("payout_due_date").alias("payout_due_date"))
    out, hot = final_index, hot_keys(final_index, key)
    for side in (times, flags.select(key, "policy_flags"), due):
        out = skew_join(out, side, key, "left", unique_right=True, hot_left=hot)
    return out.withColumn(
        "risk_label", C.risk_label(F.col("fraud_score"), F.col("policy_flags"))
    )


def merge_indexes(stream: DataFrame, batch: DataFrame, time_column: str = "timestamp") -> DataFrame:
    """Union of both indexes, newest row per transaction.

    Columns only one index has are null in the other's rows. Unreadable times lose.
    """
    both = stream.unionByName(batch, allowMissingColumns=True)
    parsed = F.try_to_timestamp(F.col(time_column))
    return latest_per_key(both, ["transaction_id"], [parsed])
