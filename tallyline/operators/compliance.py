"""Policy flags per transaction and the compliance view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .skew import attach


def policy_flags(transactions: DataFrame, policies: DataFrame) -> DataFrame:
    """Types of the active policies of each transaction, sorted and comma-separated.

    One row per transaction id; a transaction without an active policy has ''.
    """
    active = policies.where("active_flag").select("policy_id", "policy_type")
    return (
        attach(transactions.select("transaction_id", "policy_id"), active, "policy_id")
        .groupBy("transaction_id")
        .agg(F.array_join(F.sort_array(F.collect_set("policy_type")), ",").alias("policy_flags"))
    )


def compliance_index(
    transactions: DataFrame, policies: DataFrame, signals: DataFrame
) -> DataFrame:
    """Policy flags, highest score and risk label of every transaction."""
    worst = signals.groupBy("transaction_id").agg(F.max(F.nanvl("fraud_score", F.lit(None).cast("double"))).alias("fraud_score"))
    flagged = policy_flags(transactions, policies)
    # Both sides are grouped by transaction: no key is hot.
    return flagged.join(worst, "transaction_id", "left").withColumn(
        "risk_label", C.risk_label(F.col("fraud_score"), F.col("policy_flags"))
    )
