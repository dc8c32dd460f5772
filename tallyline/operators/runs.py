"""Longest runs of rows of one kind, from summaries that can be put together.

A user's rows are cut at fixed times into slices. A slice's summary holds its
first run, its last run and its best run; summaries of neighbouring slices are put
together by joining the last run of one to the first run of the next. So no task
needs all rows of a user, and new slices can be added to stored summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _best(column: str) -> Column:
    """The longest run; of equal ones the earliest."""
    return F.min(column)


def slice_summaries(
    df: DataFrame, keys: list[str], time: str, tie: list[str], hit: Column, unit: str = "day"
) -> DataFrame:
    """One row per keys and slice: hits, breaks, lead, trail and best run.

    Rows are ordered by `time`, then `tie`, which should tell rows apart; rows without a
    time have no place and are left out. `breaks` counts rows that are no hit. A run is
    (less, begin, end) with less the negative length: `lead` ends at the first break,
    `trail` starts after the last one; without breaks both are the whole slice.
    """
    rows = df.where(F.col(time).isNotNull()).select(
        *keys, F.date_trunc(unit, time).alias("slice"), F.col(time).alias("_time"),
        *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)],
        F.coalesce(hit, F.lit(False)).alias("_hit"),
    )
    ties = [f"_tie{i}" for i in range(len(tie))]
    before = (
        Window.partitionBy(*keys, "slice").orderBy("_time", *ties)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    at = F.when(F.col("_hit"), F.col("_time"))
    runs = (
        rows.withColumn("_run", F.count_if(~F.col("_hit")).over(before))
        .groupBy(*keys, "slice", "_run")
        .agg(F.count(at).alias("_length"), F.min(at).alias("begin"), F.max(at).alias("end"))
        .withColumn("_one", F.struct((-F.col("_length")).alias("less"), "begin", "end"))
    )
    return runs.groupBy(*keys, "slice").agg(
        F.sum("_length").alias("hits"),
        F.max("_run").alias("breaks"),
        F.max(F.when(F.col("_run") == 0, F.col("_one"))).alias("lead"),
        F.max_by("_one", "_run").alias("trail"),
        _best("_one").alias("best"),
    )


def longest_runs(summaries: DataFrame, keys: list[str]) -> DataFrame:
    """keys, hits, longest_run, run_begin, run_end over all slices of each key.

    The window has one row per slice of a key, however many rows those stand for.
    """
    earlier = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    broken = F.when(F.col("breaks") > 0, 1).otherwise(0)
    placed = summaries.withColumn("_joint", F.coalesce(F.sum(broken).over(earlier), F.lit(0)))
    # Between two slices with breaks all runs join: the last one of the former, whole
    # slices, and the first one of the latter.
    ends = F.array(
        F.struct(F.col("_joint").alias("joint"), F.col("lead").alias("run")),
        F.when(
            F.col("breaks") > 0,
            F.struct((F.col("_joint") + 1).alias("joint"), F.col("trail").alias("run")),
        ),
    )
    joined = (
        placed.select(*keys, F.explode(ends).alias("_end"))
        .groupBy(*keys, "_end.joint")
        .agg(
            F.coalesce(F.sum("_end.run.less"), F.lit(0)).alias("less"),
            F.min("_end.run.begin").alias("begin"), F.max("_end.run.end").alias("end"),
        )
        .select(*keys, F.lit(0).cast("long").alias("hits"), F.struct("less", "begin", "end").alias("run"))
    )
    own = placed.select(*keys, "hits", F.col("best").alias("run"))
    return (
        own.unionByName(joined).groupBy(*keys)
        .agg(F.sum("hits").alias("hits"), _best("run").alias("run"))
        .select(
            *keys, "hits", (-F.col("run.less")).alias("longest_run"),
            F.col("run.begin").alias("run_begin"), F.col("run.end").alias("run_end"),
        )
    )


def decline_runs(tx: DataFrame, unit: str = "day") -> DataFrame:
    """Declines of each user, the longest run of them and when it began and ended."""
    summaries = slice_summaries(
        tx, ["user_id"], "event_time", ["transaction_id"], F.col("status") == "DECLINED", unit
    )
    return longest_runs(summaries, ["user_id"]).select(
        "user_id", F.col("hits").alias("declines"),
        F.col("longest_run").alias("longest_decline_run"), "run_begin", "run_end",
    )
