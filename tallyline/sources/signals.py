"""Intake of posted fraud signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ML_SIGNAL, ML_SIGNAL_REQUIRED
from .sinks import write_table


def posted_records(payloads: DataFrame, column: str = "value") -> DataFrame:
    """One JSON object per row from payloads holding an object or a list of them.

    A list that does not parse stays one record, which is rejected later; an empty
    list holds none.
    """
    text = F.trim(F.col(column))
    items = F.try_variant_get(F.try_parse_json(F.col(column)), "$", "array<variant>")
    listed = F.transform(items, lambda v: F.to_json(v))
    whole = F.array(F.coalesce(text, F.lit("")))
    several = F.when(listed.isNotNull(), listed).otherwise(whole)
    return payloads.select(
        F.explode(F.when(text.startswith("["), several).otherwise(whole)).alias("record")
    )


def ingest_signals(payloads: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a record is rejected when it lacks a required field.

    A field that is present but null is accepted.
    """
    records = posted_records(payloads, column).withColumn(
        "missing",
        F.array_except(
            F.array(*[F.lit(c) for c in ML_SIGNAL_REQUIRED]),
            F.coalesce(F.json_object_keys("record"), F.array().cast("array<string>")),
        ),
    )
    complete = F.size("missing") == 0
    accepted = (
        records.where(complete).select(F.from_json("record", ML_SIGNAL).alias("r")).select("r.*")
    )
    rejected = records.where(~complete).select(
        "record", F.concat(F.lit("Missing field: "), F.col("missing")[0]).alias("error")
    )
    return accepted, rejected


def store_signals(accepted: DataFrame, path: str) -> int:
    """Add accepted signals to the stored ones."""
    return write_table(accepted, path, mode="append")


def snapshot(df: DataFrame, path: str) -> bool:
    """Write all stored signals as a fresh table; nothing is written for no rows."""
    if df.isEmpty():
        return False
    write_table(df, path)
    return True
