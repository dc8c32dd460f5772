"""Checks of keys, references and ranges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def table_checks(
    df: DataFrame,
    name: str,
    key: str,
    valid: Column,
    foreign_key: str | None = None,
    parent: DataFrame | None = None,
) -> DataFrame:
    """One row: rows, null keys, surplus copies of keys, invalid rows, orphans.

    Rows are counted per key and per reference in every task before they are
    shuffled, so a hot key is one row per task.
    """
    fk = F.col(foreign_key) if foreign_key else F.lit(None).cast("string")
    per_key = df.groupBy(F.col(key).alias("k")).agg(
        F.count("*").alias("n"),
        F.count_if(~F.coalesce(valid, F.lit(False))).alias("invalid"),
    )
    out = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n") - 1)), F.lit(0))
        .alias("duplicate_keys"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid_rows"),
    )
    if parent is None:
        orphans = per_key.agg(F.lit(0).cast("bigint").alias("orphans"))
    else:
        known = parent.select(F.col(parent.columns[0]).alias("f")).distinct()
        references = df.where(fk.isNotNull()).groupBy(fk.alias("f")).agg(F.count("*").alias("n"))
        orphans = (
            references.join(known.withColumn("known", F.lit(True)), "f", "left")
            .agg(F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0))
                 .alias("orphans"))
        )
    # Both sides are single rows: the join key is the table's name.
    return (
        out.withColumn("dataset", F.lit(name))
        .unionByName(orphans.withColumn("dataset", F.lit(name)), allowMissingColumns=True)
        .groupBy("dataset")
        .agg(*[F.max(c).alias(c) for c in [*out.columns, "orphans"]])
    )


def quality_report(checks: list[DataFrame]) -> DataFrame:
    """The checks of several tables, one row per table."""
    return reduce(DataFrame.unionByName, checks)
