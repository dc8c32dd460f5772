"""Unnesting arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unnest(
    df: DataFrame, column: str, alias: str, fields: list[str] | None = None
) -> DataFrame:
    """One row per array element; rows with a null or empty array vanish.

    For arrays of structs name the fields that are needed: Spark prunes at most
    one field through an explode, but any number through the zipped arrays.
    """
    array = F.arrays_zip(*[F.col(f"{column}.{f}") for f in fields]) if fields else F.col(column)
    return df.withColumn(alias, F.explode(array))


def heads(orders: DataFrame) -> DataFrame:
    """One row per order of a table that keeps very large orders in parts."""
    return orders.where("part_no = 0")
