"""Reports over the final index. A report whose column is missing is empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import FRAUD_THRESHOLD
from ..schemas import MONEY

# Labels that need a compliance review.
REVIEW_LABELS = ["HIGH_RISK", "REQUIRES_KYC", "BLACKLISTED"]


def _report(df: DataFrame, needed: str, condition) -> DataFrame:
    if needed not in df.columns:
        return df.where(F.lit(False))
    return df.where(condition(F.col(needed)))


def fraud_alerts(final: DataFrame, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """Rows scored above the threshold. NaN is no score."""
    return _report(final, "fraud_score", lambda c: (c > threshold) & ~F.isnan(c))


def discrepancies(final: DataFrame) -> DataFrame:
    """Rows whose difference is not zero; a missing difference counts as one."""
    return _report(final, "discrepancy", lambda c: ~c.eqNullSafe(F.lit(0)))


def compliance_cases(final: DataFrame) -> DataFrame:
    return _report(final, "risk_label", lambda c: c.isin(REVIEW_LABELS))


def settlements_due(final: DataFrame) -> DataFrame:
    return _report(final, "payout_due_date", lambda c: c.isNotNull())


def rows_of(final: DataFrame, column: str, value: str) -> DataFrame:
    """Detail rows of one merchant or user."""
    return _report(final, column, lambda c: c == value)


def _with_columns(final: DataFrame) -> DataFrame:
    """Columns of the sums below that the index lacks: no id, amount 0."""
    missing = {
        "user_id": F.lit(None).cast("string"),
        "merchant_id": F.lit(None).cast("string"),
        "transaction_id": F.lit(None).cast("string"),
        "amount": F.lit(0).cast(MONEY),
    }
    return final.withColumns({c: v for c, v in missing.items() if c not in final.columns})


def _mean(total: Column, n: Column) -> Column:
    """total / n as double, 0 for no rows."""
    return F.when(n > 0, F.try_divide(total.cast("double"), n.cast("double"))).otherwise(0.0)


def merchant_summary(final: DataFrame, merchant: str | None = None) -> DataFrame:
    """Volume, refunds and mean per merchant, or of one merchant."""
    if merchant is not None:
        final = rows_of(final, "merchant_id", merchant)
    amount = F.col("amount") if "amount" in final.columns else F.lit(0).cast(MONEY)
    refunded = F.col("status") == "REFUNDED" if "status" in final.columns else F.lit(False)
    return (
        final.groupBy("merchant_id")
        .agg(
            F.count("*").alias("transaction_count"),
            F.count_if(refunded).alias("refund_count"),
            F.coalesce(F.sum(amount), F.lit(0)).alias("total_volume"),
        )
        .withColumn("average_tx", _mean(F.col("total_volume"), F.col("transaction_count")))
    )


def user_spend(final: DataFrame, user: str | None = None, time: str = "event_time") -> DataFrame:
    """Spend, number of merchants and last transaction per user, or of one user."""
    final = _with_columns(final)
    if user is not None:
        final = rows_of(final, "user_id", user)
    last = F.col(time) if time in final.columns else F.lit(None).cast("timestamp")
    # Sums per (user, merchant) first: a user with very many rows never sends
    # more than one row per merchant to the task that counts merchants.
    return (
        final.groupBy("user_id", "merchant_id")
        .agg(F.sum("amount").alias("spend"), F.max(last).alias("last_tx"))
        .groupBy("user_id")
        .agg(
            F.coalesce(F.sum("spend"), F.lit(0)).alias("total_spend"),
            F.count("merchant_id").alias("unique_merchants"),
            F.max("last_tx").alias("last_tx_time"),
        )
    )


def merchant_aggregate(final: DataFrame) -> DataFrame:
    """Merchants by volume, the rows without a merchant as a group of their own."""
    return (
        _with_columns(final).groupBy("merchant_id")
        .agg(
            F.coalesce(F.sum("amount"), F.lit(0)).alias("total_volume"),
            F.count("transaction_id").alias("tx_count"),
        )
        .withColumn("average_tx", _mean(F.col("total_volume"), F.col("tx_count")))
        .orderBy(F.col("total_volume").desc(), F.col("merchant_id").asc_nulls_last())
    )


def top_merchants(final: DataFrame, n: int = 5) -> DataFrame:
    """The merchants of highest volume; a missing id is UNKNOWN, a missing amount 0."""
    merchant = F.coalesce(F.nullif(F.col("merchant_id"), F.lit("")), F.lit("UNKNOWN"))
    return (
        _with_columns(final).groupBy(merchant.alias("merchant"))
        .agg(F.sum(F.coalesce("amount", F.lit(0))).alias("volume"))
        .orderBy(F.col("volume").desc(), "merchant")
        .limit(n)
    )
