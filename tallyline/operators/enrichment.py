"""Table-in, table-out jobs over the column rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C


def with_score_label(df: DataFrame, score: str = "fraud_score_100") -> DataFrame:
    return df.withColumn("risk_level", C.score_label(F.col(score)))


def score_label_counts(df: DataFrame, score: str = "fraud_score_100") -> DataFrame:
    """Number of signals per label."""
    return with_score_label(df, score).groupBy("risk_level").agg(F.count("*").alias("signals"))


def with_masked_name(df: DataFrame, name: str = "user_name") -> DataFrame:
    return df.withColumn(name, C.masked_name(F.col(name)))


def with_masked_id(df: DataFrame, column: str = "user_id") -> DataFrame:
    return df.withColumn(f"masked_{column}", C.masked_id(F.col(column)))


def with_policy_region(df: DataFrame, details: str = "policy_details") -> DataFrame:
    return df.withColumn("policy_region", C.policy_region(F.col(details)))


def with_amount_usd(df: DataFrame) -> DataFrame:
    return df.withColumn("amount_usd", C.amount_in_usd(F.col("amount"), F.col("currency")))


def with_rounded_amount(df: DataFrame, amount: str = "amount") -> DataFrame:
    return df.withColumn(amount, C.rounded_amount(F.col(amount)))


def with_iso_date(df: DataFrame, column: str = "signup_date") -> DataFrame:
    return df.withColumn(column, C.iso_date(F.col(column)))


def with_discrepancy(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "discrepancy", C.discrepancy(F.col("amount"), F.col("amount_posted"))
    )


def with_risk_label(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_label", C.risk_label(F.col("fraud_score"), F.col("policy_flags")))


def with_final_status(df: DataFrame, bank_status: str = "reconciliation_status") -> DataFrame:
    return df.withColumn("final_status", C.final_status(F.col("status"), F.col(bank_status)))


def daily_merchant_kpi(df: DataFrame) -> DataFrame:
    """KPI of each merchant's value per day."""
    return (
        df.groupBy("merchant_id", F.to_date("event_time").alias("day"))
        .agg(F.sum("amount").alias("daily_value"))
        .withColumn("kpi", C.merchant_kpi(F.col("merchant_id"), F.col("daily_value")))
    )
