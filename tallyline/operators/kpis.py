"""Merchant, user, settlement, operations and score-level figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .latest import latest_per_key
from .skew import skew_join


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))


def merchant_daily_kpi(final: DataFrame) -> DataFrame:
    """Volume, mean size, refund rate and high-risk share per merchant and day."""
    n = F.col("transactions")
    return (
        final.groupBy("merchant_id", F.to_date("event_time").alias("day"))
        .agg(
            F.count("*").alias("transactions"),
            F.coalesce(F.sum("amount"), F.lit(0)).alias("volume"),
            F.count_if(F.col("status") == "REFUNDED").alias("refunds"),
            F.count_if(F.col("risk_label") == "HIGH_RISK").alias("high_risk"),
        )
        .withColumn("average_size", _ratio(F.col("volume"), n))
        .withColumn("refund_rate", _ratio(F.col("refunds"), n))
        .withColumn("risk_exposure", _ratio(F.col("high_risk"), n))
    )


def _mean_and_deviation(x: Column) -> tuple[Column, Column, Column]:
    """Count, exact sum and exact sum of squares of a money column."""
    return (
        F.count(x).alias("n"),
        F.sum(x).alias("s"),
        F.sum((x * x).cast("decimal(38,4)")).alias("q"),
    )


def _deviation(n: Column, s: Column, q: Column) -> Column:
    """Population standard deviation from exact sums."""
    n, s, q = n.cast("double"), s.cast("double"), q.cast("double")
    variance = F.greatest(F.try_divide(q, n) - F.try_divide(s, n) * F.try_divide(s, n), F.lit(0.0))
    return F.sqrt(variance)


def user_months(tx: DataFrame, repeated: int = 2) -> DataFrame:
    """Spend, typical amount, declines and favourite merchant per user and month."""
    month = F.date_format(F.trunc("event_time", "month"), "yyyy-MM")
    per_merchant = tx.groupBy("user_id", month.alias("month"), "merchant_id").agg(
        F.count("*").alias("visits"),
        F.sum("amount").alias("spend"),
        F.count_if(F.col("status") == "DECLINED").alias("declines"),
    )
    # The group below has one row per merchant, not per transaction, and a
    # struct of (visits, id) finds the favourite without a window.
    rank = F.struct(F.col("visits"), F.coalesce("merchant_id", F.lit("")).alias("m"))
    return (
        per_merchant.groupBy("user_id", "month")
        .agg(
            F.sum("visits").alias("transactions"),
            F.sum("spend").alias("monthly_spend"),
            F.sum("declines").alias("declines"),
            F.max(rank).alias("top"),
        )
        .select(
            "user_id", "month", "transactions", "monthly_spend",
            _ratio(F.col("monthly_spend"), F.col("transactions")).alias("typical_amount"),
            "declines",
            (F.col("declines") >= repeated).alias("repeated_declines"),
            F.nullif(F.col("top.m"), F.lit("")).alias("frequent_merchant"),
        )
    )


def user_spikes(tx: DataFrame, sigmas: float = 1.5) -> DataFrame:
    """Transactions far above their user's mean, in standard deviations."""
    stats = tx.groupBy("user_id").agg(*_mean_and_deviation(F.col("amount"))).select(
        "user_id",
        _ratio(F.col("s"), F.col("n")).alias("mean_amount"),
        _deviation(F.col("n"), F.col("s"), F.col("q")).alias("deviation"),
    )
    joined = skew_join(
        tx.select("transaction_id", "user_id", "amount"), stats, "user_id", unique_right=True
    )
    score = F.try_divide(F.col("amount").cast("double") - F.col("mean_amount"), F.col("deviation"))
    return (
        joined.withColumn("z_score", score)
        .where(F.col("z_score") > sigmas)
        .withColumn("z_score", F.round("z_score", 6))
    )


def settlement_schedule(
    transactions: DataFrame, statements: DataFrame, as_of: str, days: int = 2, grace: int = 30
) -> DataFrame:
    """When each posted transaction is paid out, and how that stands on `as_of`.

    Due `days` after posting. Completed once `grace` more days have passed,
    Pending before the due date, Delayed in between. One row per transaction:
    the latest statement counts.
    """
    posted = latest_per_key(
        statements.select("transaction_id", "statement_id", "posting_date", "amount_posted"),
        ["transaction_id"], ["posting_date"], ["statement_id"],
    )
    due = F.date_add("posting_date", days)
    today = F.lit(as_of).cast("date")
    return (
        skew_join(
            transactions.select("transaction_id", "merchant_id"), posted, "transaction_id",
            "inner", unique_right=True,
        )
        .withColumn("payout_due_date", due)
        .withColumn(
            "payout_status",
            F.when(today < due, "Pending")
            .when(today > F.date_add(due, grace), "Completed")
            .otherwise("Delayed"),
        )
    )


def settlements_by_merchant(schedule: DataFrame) -> DataFrame:
    return schedule.groupBy("merchant_id", "payout_due_date", "payout_status").agg(
        F.count("*").alias("payouts"), F.sum("amount_posted").alias("amount_due")
    )


def ops_index(
    events: DataFrame,
    time: str,
    is_error: Column,
    latency: Column | None = None,
    size: str = "5 minutes",
    slide: str | None = None,
) -> DataFrame:
    """Throughput, error rate and mean latency per time window; batch or stream."""
    latency = F.lit(None).cast("decimal(18,2)") if latency is None else latency
    return (
        events.groupBy(F.window(time, size, slide).alias("w"))
        .agg(
            F.count("*").alias("throughput"),
            F.count_if(is_error).alias("errors"),
            F.sum(latency).alias("latency_sum"),
            F.count(latency).alias("latency_n"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "throughput",
            "errors",
            _ratio(F.col("errors"), F.col("throughput")).alias("error_rate"),
            _ratio(F.col("latency_sum"), F.col("latency_n")).alias("mean_latency"),
        )
    )


def score_anomalies(
    signals: DataFrame, hours: int = 24, sigmas: float = 1.0, time: str = "inference_time"
) -> DataFrame:
    """Hours whose mean score exceeds the trailing hours' mean by `sigmas` deviations.

    The window sees one row per model and hour, however many signals there are.
    """
    # Means are whole millionths, so sums over hours are exact.
    millionths = F.sum(F.col("fraud_score").cast("decimal(18,6)") * 1_000_000).cast("bigint")
    hourly = (
        signals.groupBy("model_version", F.date_trunc("hour", time).alias("hour"))
        .agg(F.count("fraud_score").alias("signals"), millionths.alias("total"))
        .where("signals > 0")
        .withColumn("mean", F.expr("total div signals"))
    )
    trailing = Window.partitionBy("model_version").orderBy("hour").rowsBetween(-hours, -1)
    return (
        hourly.withColumn("n", F.count("mean").over(trailing))
        .withColumn("s", F.sum("mean").over(trailing))
        .withColumn("q", F.sum(F.expr("mean * mean")).over(trailing))
        .withColumn("baseline", _ratio(F.col("s"), F.col("n")))
        .withColumn("deviation", _deviation(F.col("n"), F.col("s"), F.col("q")))
        .where(
            (F.col("n") == hours)
            & (F.col("mean").cast("double") > F.col("baseline") + sigmas * F.col("deviation"))
        )
        .select(
            "model_version", "hour", "signals",
            (F.col("mean") / 1e6).alias("mean_score"),
            (F.col("baseline") / 1e6).alias("baseline"),
        )
    )


def score_baselines(
    signals: DataFrame, hours: int = 24, sigmas: float = 1.0, time: str = "inference_time"
) -> DataFrame:
    """Each hour's number of signals and mean score against the `hours` before it.

    The clock decides what lies before: hours without signals count as hours with
    zero signals, and the mean score is that of the signals, not of the hours. One row
    for each hour from a model's first to its last; the first `hours` of them have no
    baseline. The window sees one row per model and hour.
    """
    millionths = F.sum(F.col("fraud_score").cast("decimal(18,6)") * 1_000_000).cast("bigint")
    seen = signals.groupBy("model_version", F.date_trunc("hour", time).alias("hour")).agg(
        F.count("fraud_score").alias("signals"), F.coalesce(millionths, F.lit(0)).alias("total")
    ).where(F.col("hour").isNotNull())
    # The hours in between: as many as the clock has, whatever the number of signals.
    following = F.lead("hour").over(Window.partitionBy("model_version").orderBy("hour"))
    step = F.expr("INTERVAL 1 HOUR")
    filled = seen.withColumn("_next", following).withColumn(
        "_at", F.explode(F.sequence("hour", F.coalesce(F.col("_next") - step, F.col("hour")), step))
    )
    real = F.col("_at") == F.col("hour")
    # Hours numbered from an arbitrary one, so that the frame is a range of hours.
    number = F.timestamp_diff("HOUR", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("_at").cast("timestamp_ntz"))
    grid = filled.select(
        "model_version", F.col("_at").alias("hour"), number.alias("_hour"),
        F.when(real, F.col("signals")).otherwise(0).alias("signals"),
        F.when(real, F.col("total")).otherwise(0).alias("total"),
    )
    trailing = Window.partitionBy("model_version").orderBy("_hour").rangeBetween(-hours, -1)
    first = F.min("_hour").over(Window.partitionBy("model_version"))
    counts = F.col("signals")
    full = F.col("_hour") - first >= hours
    return (
        grid.withColumn("_full", full)
        .withColumn("_s", F.sum(counts).over(trailing))
        .withColumn("_q", F.sum(counts * counts).over(trailing))
        .withColumn("_t", F.sum("total").over(trailing))
        .where("_full")
        .withColumn("usual_signals", F.col("_s") / F.lit(float(hours)))
        .withColumn("deviation", _deviation(F.lit(hours), F.col("_s"), F.col("_q")))
        .select(
            "model_version", "hour", "signals", "usual_signals",
            (F.col("signals") > F.col("usual_signals") + sigmas * F.col("deviation")).alias("burst"),
            (_ratio(F.col("total"), counts) / 1e6).alias("mean_score"),
            (_ratio(F.col("_t"), F.col("_s")) / 1e6).alias("baseline"),
        )
    )
