"""Rows with the same text, put aside before the costly steps.

What holds for a text holds for its copies, so only the first document of each
text (the smallest doc_id) takes part in comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SKETCH, SeenTwice, partition_sketch, texts, written

TEXT = ["mark", "check", "n_chars"]  # stands for a text: 64 + 32 bits and its length
SKETCH_ROWS, SKETCH_BITS = 2, 25


def identified(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """doc_id, mark, check, n_chars and the text, changed as asked for."""
    rows = texts(docs).select("doc_id", (F.col("text") if text is None else text).alias("text"))
    return rows.select(
        "doc_id",
        F.xxhash64("text").alias("mark"),
        F.crc32(F.encode("text", "UTF-8")).alias("check"),
        F.length("text").alias("n_chars"),
        "text",
    )


def copied_marks(sizes: DataFrame, bits: int = SKETCH_BITS) -> SeenTwice:
    """Marks that may stand in two rows or more."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        marks = (b.mark.to_numpy().view(np.uint64) for b in batches)
        return partition_sketch(marks, SKETCH_ROWS, bits)

    return SeenTwice.collect(sizes.select("mark").mapInPandas(count, SKETCH), SKETCH_ROWS, bits)


class Firsts:
    """The rows that stand for their text, to be read with `of` in Python passes.

    `rows` holds every row, marked doubtful, and the first document of each text
    that more rows may have, not marked. A doubtful row counts when the sketch is
    sure that no other row has its text, which only Python can ask.
    """

    def __init__(self, rows: DataFrame, sizes: DataFrame):
        copied = copied_marks(sizes)
        self.shared = rows.sparkSession.sparkContext.broadcast(
            (copied.rows, copied.bits, copied.cells)
        )
        rows = rows.select("doc_id", "mark", "text")
        least = sizes.groupBy(*TEXT).agg(F.min("doc_id").alias("doc_id"))
        firsts = written(
            rows.mapInPandas(self._copied(), "doc_id long, mark long, text string")
            .join(least.select("doc_id", "mark"), ["doc_id", "mark"])
            .dropDuplicates(["doc_id", "mark"])
            .select("doc_id", "mark", "text"),
            "firsts",
        )
        self.rows = rows.withColumn("doubtful", F.lit(True)).unionByName(
            firsts.withColumn("doubtful", F.lit(False))
        )

    def _copied(self):
        shared = self.shared

        def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sketch = SeenTwice(*shared.value)
            for batch in batches:
                yield batch[sketch.maybe(batch.mark.to_numpy().view(np.uint64))]

        return pick

    def map(self, function, schema: str) -> DataFrame:
        """mapInPandas over the rows that count, with doc_id, mark and text."""
        shared = self.shared

        def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sketch = SeenTwice(*shared.value)
            for batch in batches:
                may = sketch.maybe(batch.mark.to_numpy().view(np.uint64))
                yield batch[~(batch.doubtful.to_numpy() & may)]

        return self.rows.mapInPandas(lambda batches: function(counted(batches)), schema)
