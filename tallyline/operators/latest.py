"""Keeping the newest row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: list[str], newest: list[str | Column], ties: list[str] | None = None
) -> DataFrame:
    """One row per key: the highest `newest`, then the highest `ties`.

    The filter on row_number() lets Spark keep one row per key in every map
    task (WindowGroupLimit), so a hot key sends few rows through the shuffle.
    Without `ties` all other columns break ties.
    """
    if ties is None:
        ties = [
            f.name
            for f in df.schema.fields
            if f.name not in keys and "map<" not in f.dataType.simpleString()
        ]
    newest = [F.col(c) if isinstance(c, str) else c for c in newest]
    order = [c.desc_nulls_last() for c in newest] + [F.col(c).desc_nulls_last() for c in ties]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
