"""Matching transactions with bank statements and with their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from .latest import latest_per_key
from .skew import attach, skew_join

# Columns of the batch index, in order.
MATCH_COLUMNS = [
    "transaction_id",
    "merchant_id",
    "user_id",
    "amount",
    "currency",
    "status",
    "statement_id",
    "posting_date",
    "amount_posted",
    "fee_charged",
    "discrepancy",
    "reconciliation_status",
    "batch_run_timestamp",
]


def stamp_run(df: DataFrame, run_ts: str, column: str) -> DataFrame:
    """Add the run's timestamp, given by the caller so that a rerun repeats it."""
    return df.withColumn(column, F.lit(run_ts))


def match_statements(
    transactions: DataFrame, statements: DataFrame, run_ts: str, dedupe: bool = False
) -> DataFrame:
    """Every transaction with its bank statements, difference and status.

    A transaction with several statements gives several rows, unless `dedupe`
    keeps the latest statement per transaction.
    """
    if dedupe:
        statements = latest_per_key(
            statements, ["transaction_id"], ["posting_date"], ["statement_id"]
        )
    matched = skew_join(transactions, statements, "transaction_id", "left", unique_right=dedupe)
    matched = matched.withColumn(
        "discrepancy", C.discrepancy(F.col("amount"), F.col("amount_posted"))
    ).withColumn("reconciliation_status", C.match_status(F.col("statement_id")))
    return stamp_run(matched, run_ts, "batch_run_timestamp").select(*MATCH_COLUMNS)


def star_enrich(
    transactions: DataFrame, policies: DataFrame, merchants: DataFrame, users: DataFrame
) -> DataFrame:
    """Transactions with policy, merchant and user columns; no transaction is lost.

    Each dimension is broadcast when its measured size allows; otherwise its
    join is shuffled with hot merchants or users cut into slices.
    """
    out = attach(transactions, policies, "policy_id")
    out = attach(out, merchants, "merchant_id")
    return attach(out, users, "user_id")


def unmatched_both_sides(transactions: DataFrame, statements: DataFrame) -> DataFrame:
    """Full comparison: MATCHED, PARTIAL (posted below the amount), UNMATCHED, ORPHAN.

    Built as a left join plus the statements without a transaction, so that the
    hot-key handling of the joins applies to both halves.
    """
    tx = transactions.select("transaction_id", "amount")
    st = statements.select("statement_id", "transaction_id", "amount_posted")
    posted, amount = F.col("amount_posted"), F.col("amount")
    paired = skew_join(tx, st, "transaction_id", "left").withColumn(
        "reconciled_status",
        F.when(F.col("statement_id").isNull(), "UNMATCHED")
        .when((posted > 0) & (posted < amount), "PARTIAL")
        .otherwise("MATCHED"),
    )
    known = tx.select("transaction_id").distinct().withColumn("known", F.lit(True))
    orphans = (
        skew_join(st, known, "transaction_id", "left", unique_right=True)
        .where(F.col("known").isNull())
        .drop("known")
        .withColumn("reconciled_status", F.lit("ORPHAN"))
    )
    return paired.unionByName(orphans, allowMissingColumns=True).withColumn(
        "difference", C.discrepancy(amount, posted)
    )
