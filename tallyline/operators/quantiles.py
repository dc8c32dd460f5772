"""Quantiles of large groups: exact ones by selection, and sketches that add up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEPS = 5  # bits of a value told apart by its bucket: 32 buckets for each doubling


def value_bucket(value: Column) -> Column:
    """Ordered bucket of a whole number: exact up to 63, then 32 for each doubling.

    At most about 4000 buckets cover all 64-bit values.
    """
    size = F.abs(value)
    shift = F.greatest(F.length(F.bin(size)) - (STEPS + 1), F.lit(0))
    # Spark's shift operator takes literals only; powers of two divide the same way.
    bucket = shift * (1 << STEPS) + F.call_function("div", size, F.pow(F.lit(2), shift).cast("long"))
    return F.when(value < 0, -bucket).otherwise(bucket)


def exact_quantiles(
    df: DataFrame, keys: list[str], value: Column, quantiles: dict[str, float]
) -> DataFrame:
    """keys, values, and each named quantile of whole numbers, interpolated, as a double.

    Selection instead of sorting: values are counted, the counts are added up by
    bucket, and only buckets that hold a wanted rank are opened. No row holds a list
    of a group's values; a window sees a group's buckets, or the different values of
    one bucket. Null values do not count; a group without values has no row.
    """
    counted = (
        df.select(*keys, value.cast("long").alias("value")).where("value IS NOT NULL")
        .groupBy(*keys, "value").agg(F.count("*").alias("n"))
        .withColumn("bucket", value_bucket(F.col("value")))
    )
    group = Window.partitionBy(*keys)
    up_to = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        counted.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(up_to), F.lit(0)))
        .withColumn("values", F.sum("n").over(group))
    )

    def place(q: float) -> Column:
        return (F.col("values") - 1) * F.lit(float(q))

    ends = [f(place(q)).cast("long") for q in quantiles.values() for f in (F.floor, F.ceil)]
    here = F.filter(
        F.array_distinct(F.array(*ends)),
        lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("n")),
    )
    opened = buckets.select(
        *[F.col(k).alias(f"_{k}") for k in [*keys, "bucket"]], "before", "values",
        here.alias("ranks"),
    ).where(F.size("ranks") > 0)
    # Null keys are groups too.
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in [*keys, "bucket"]]
    inside = counted.join(opened, reduce(lambda a, b: a & b, same))
    in_bucket = (
        Window.partitionBy(*keys, "bucket").orderBy("value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("before") + F.coalesce(F.sum("n").over(in_bucket), F.lit(0))
    found = inside.withColumn("first", first).select(
        *keys, "values", "value",
        F.explode(F.filter("ranks", lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("n")))).alias("rank"),
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(F.col("rank") == rank.cast("long"), F.col("value"))).cast("double")

    named = found.groupBy(*keys, "values").agg(
        *[
            at(f(place(q))).alias(f"{name}_{end}")
            for name, q in quantiles.items()
            for end, f in (("low", F.floor), ("high", F.ceil))
        ]
    )
    return named.select(
        *keys, "values",
        *[
            (
                F.col(f"{name}_low")
                + (F.col(f"{name}_high") - F.col(f"{name}_low")) * (place(q) - F.floor(place(q)))
            ).alias(name)
            for name, q in quantiles.items()
        ],
    )


def typical_amounts(tx: DataFrame) -> DataFrame:
    """Exact median and 95th percentile of each user's amounts in each month.

    Both lie on multiples of a twentieth of a cent; rounding only removes what
    doubles add.
    """
    month = F.date_format(F.trunc("event_time", "month"), "yyyy-MM")
    cents = F.col("amount").cast("decimal(20,2)") * 100
    found = exact_quantiles(
        tx.withColumn("month", month), ["user_id", "month"], cents,
        {"median_amount": 0.5, "p95_amount": 0.95},
    )
    return found.select(
        "user_id", "month", F.col("values").alias("transactions"),
        F.round(F.col("median_amount") / 100, 4).alias("median_amount"),
        F.round(F.col("p95_amount") / 100, 4).alias("p95_amount"),
    )


# --- sketches -------------------------------------------------------------------

ACCURACY = 800  # of the sketch: ranks are off by well below a hundredth
TAILS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def window_sketches(
    events: DataFrame, time: str, value: Column, size: str = "5 minutes"
) -> DataFrame:
    """window_start, values and a quantile sketch of `value` per window; batch or stream.

    A sketch takes a few kilobytes, whatever the number of values. Sketches are built
    in the tasks that read the rows and put together after the shuffle.
    """
    number = value.cast("double")
    return (
        events.groupBy(F.window(time, size).alias("w"))
        .agg(
            F.count(number).alias("values"),
            F.kll_sketch_agg_double(number, F.lit(ACCURACY)).alias("sketch"),
        )
        .select(F.col("w.start").alias("window_start"), "values", "sketch")
    )


def roll_up(sketches: DataFrame, size: str = "1 hour") -> DataFrame:
    """Sketches of larger windows from those of smaller ones, without any row."""
    return (
        sketches.groupBy(F.window("window_start", size).alias("w"))
        .agg(
            F.sum("values").alias("values"),
            F.kll_merge_agg_double("sketch", F.lit(ACCURACY)).alias("sketch"),
        )
        .select(F.col("w.start").alias("window_start"), "values", "sketch")
    )


def tails(sketches: DataFrame, quantiles: dict[str, float] | None = None) -> DataFrame:
    """window_start, values and the named quantiles of each sketch; none without values."""
    return sketches.where(F.col("values") > 0).select(
        "window_start", "values",
        *[
            F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(name)
            for name, q in (quantiles or TAILS).items()
        ],
    )


def rank_errors(
    events: DataFrame, time: str, value: Column, found: DataFrame, size: str = "1 hour",
    quantiles: dict[str, float] | None = None,
) -> DataFrame:
    """How far the rank of each reported quantile is from the rank asked for.

    One more pass over the rows: per window, the shares of values below and up to the
    reported one; the error is the distance of the asked share from that span.
    """
    quantiles = quantiles or TAILS
    rows = events.select(
        F.window(time, size)["start"].alias("window_start"), value.cast("double").alias("_value")
    )
    counts = [
        F.count_if(F.col("_value") < F.col(name)).alias(f"_{name}_below") for name in quantiles
    ] + [F.count_if(F.col("_value") <= F.col(name)).alias(f"_{name}_to") for name in quantiles]
    measured = rows.join(found, "window_start").groupBy("window_start", "values").agg(*counts)
    return measured.select(
        "window_start", "values",
        *[
            F.greatest(
                F.lit(0.0),
                F.col(f"_{name}_below") / F.col("values") - q,
                q - F.col(f"_{name}_to") / F.col("values"),
            ).alias(f"{name}_error")
            for name, q in quantiles.items()
        ],
    )
