"""What the text operators share: columns, words, written tables, ranks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_path

# A word is a run of characters other than space, tab and the line ends.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")


# Stands for a missing doc_id inside the operators: smaller than any real one.
NO_ID = -(1 << 63)


def row_key() -> Column:
    """doc_id, or a negative hash of the text in rows without one.

    Rows without an id are told apart by their texts, and come before real ids,
    as NO_ID does.
    """
    own = F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).bitwiseOR(F.lit(NO_ID))
    return F.coalesce(F.col("doc_id").cast("long"), F.greatest(own, F.lit(NO_ID + 1)))


def chosen(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of `docs` whose row_key is among the doc_ids of `keys` (left_anti: is not)."""
    ids = keys.select(F.col("doc_id").alias("__llm_id")).distinct()
    return docs.withColumn("__llm_id", row_key()).join(ids, "__llm_id", how).select(*docs.columns)


# Rows handed to Python at once: texts may be long.
BATCH = 500


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (null: NO_ID), text (null: empty) and the columns asked for; no others."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def arrow_batches(spark: SparkSession, rows: int = 10_000, size: str = "16m") -> None:
    """Batches handed to Python end at so many rows or bytes, whichever comes first."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def named(df: DataFrame, *columns: str) -> DataFrame:
    """Turn NO_ID back into null in doc_id and the given columns."""
    return df.withColumns(
        {c: F.when(F.col(c) != NO_ID, F.col(c)) for c in ("doc_id", *columns)}
    )


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write to the shared folder and read back: a lost executor repeats one job only."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def held_out() -> Column:
    """Documents no model may learn labels from."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def ranked(df: DataFrame, key: str, ids: list[str], rows_each: int = 1_000_000) -> DataFrame:
    """Add `rank`, gapless from 0 within each `key`, without one task per key.

    Rows of a key are dealt over slices by a hash of `ids`; a slice is numbered
    by itself and starts where the slices before it end. A key gets a slice for
    every `rows_each` rows, so no key is too large for a task. `key` must take a
    bounded number of values, as the slice counts are broadcast.
    """
    counts = df.groupBy(key).agg(F.ceil(F.count("*") / F.lit(rows_each)).alias("_slices"))
    sliced = df.join(F.broadcast(counts), key).withColumn(
        "_slice", F.pmod(F.xxhash64(*ids), F.col("_slices"))
    )
    starts = sliced.groupBy(key, "_slice").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        key, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    own = Window.partitionBy(key, "_slice").orderBy(*ids)
    return (
        sliced.withColumn("_own", F.row_number().over(own) - 1)
        .join(starts, [key, "_slice"])
        .withColumn("rank", (F.col("_before") + F.col("_own")).cast("long"))
        .drop("_slices", "_slice", "_own", "_before")
    )


# --- hashes of words and word windows -------------------------------------------


class WordHashes(dict):
    """64-bit hash of a word, remembered; emptied when it holds many words."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


# Odd multipliers (invertible modulo 2**64) for window hashes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Windows:
    """Hashes of all runs of n consecutive words, by differences of running sums."""

    def __init__(self):
        self._powers = {}

    def _table(self, base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        have = self._powers.get(base)
        if have is None or len(have[0]) < size:
            size = max(size, 4096, 2 * len(have[0]) if have else 0)
            inverse = pow(base, -1, 1 << 64)
            out = []
            for factor in (base, inverse):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                out.append(np.multiply.accumulate(steps))
            have = self._powers[base] = tuple(out)
        return have

    def of(self, hashes: np.ndarray, n: int, base: int = BASES[0]) -> np.ndarray:
        count = len(hashes) - n + 1
        if count <= 0:
            return np.empty(0, np.uint64)
        powers, inverses = self._table(base, len(hashes) + 1)
        sums = np.empty(len(hashes) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(hashes * powers[: len(hashes)], out=sums[1:])
        return mix((sums[n:] - sums[:count]) * inverses[:count])


# --- keys seen at least twice ---------------------------------------------------

MAP_BYTES = 4096  # size of one of Spark's bitmaps


class SeenTwice:
    """Which counters of a count-min sketch reached two.

    `rows` counters of `1 << bits` cells per key. An answer of False is certain;
    True may be wrong when other keys share all cells of a key. Size in memory:
    rows * 2**bits / 8 bytes, whatever the number of keys.
    """

    def __init__(self, rows: int, bits: int, cells: np.ndarray):
        self.rows, self.bits, self.cells = rows, bits, cells

    @staticmethod
    def positions(keys: np.ndarray, rows: int, bits: int) -> list[np.ndarray]:
        out = []
        for row in range(rows):
            seed = np.uint64((0x632BE59BD9B4E019 * (row + 1)) & ((1 << 64) - 1))
            cell = mix(keys ^ seed) >> np.uint64(64 - bits)
            out.append(cell + np.uint64(row << bits))
        return out

    def maybe(self, keys: np.ndarray) -> np.ndarray:
        """True where a key may have been counted twice."""
        out = np.ones(len(keys), bool)
        for cell in self.positions(keys, self.rows, self.bits):
            out &= (self.cells[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0
        return out

    @classmethod
    def collect(cls, sketches: DataFrame, rows: int, bits: int) -> SeenTwice:
        """Merge partition sketches: add up counters (cell, n), keep one bit for each of 2 or more.

        At most rows * 2**bits / 32768 bitmaps of 4096 bytes reach the driver.
        """
        full = sketches.groupBy("cell").agg(F.sum("n").alias("n")).where("n >= 2")
        # Spark's bitmaps count positions from 1: bucket 1 has cells 0 to 32767.
        maps = full.groupBy(F.expr("bitmap_bucket_number(cell + 1)").alias("bucket")).agg(
            F.expr("bitmap_construct_agg(bitmap_bit_position(cell + 1))").alias("bits")
        )
        cells = np.zeros((rows << bits) // 8 + MAP_BYTES, np.uint8)
        for r in maps.collect():
            at = (r.bucket - 1) * MAP_BYTES
            cells[at : at + MAP_BYTES] = np.frombuffer(r.bits, np.uint8)
        return cls(rows, bits, cells)


AMONG_BITS = 26


def _looked_up(df: DataFrame, ids: DataFrame, bits: int, key: str, how: str) -> tuple[DataFrame, Column]:
    """`df` joined with the broadcast bitmap of `ids`, and what it says of `key`."""
    cell = F.pmod(F.xxhash64(key), F.lit(1 << bits)) + 1
    maps = (
        ids.select(cell.alias("cell")).distinct()
        .groupBy(F.bitmap_bucket_number("cell").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("_map"))
    )
    marked = df.withColumns(
        {"_bucket": F.bitmap_bucket_number(cell), "_bit": F.bitmap_bit_position(cell)}
    )
    byte = F.conv(F.hex(F.expr("substring(_map, int(_bit div 8) + 1, 1)")), 16, 10).cast("int")
    hit = F.getbit(byte, F.expr("int(_bit % 8)")) == 1
    return marked.join(F.broadcast(maps), "_bucket", how), hit


def maybe_in(
    df: DataFrame, ids: DataFrame, name: str, bits: int = AMONG_BITS, key: str = "doc_id"
) -> DataFrame:
    """Add a boolean: whether `key` may be in `ids`, as `among` tells; False is certain."""
    looked, hit = _looked_up(df, ids, bits, key, "left")
    return looked.select(*df.columns, F.coalesce(hit, F.lit(False)).alias(name))


def among(
    df: DataFrame, ids: DataFrame, bits: int = AMONG_BITS, key: str = "doc_id", but: bool = False
) -> DataFrame:
    """Rows of `df` whose `key` may be in `ids` (the same column), told before any shuffle.

    With `but` all other rows, none of which has its key there.

    Drops no row whose key is there, and keeps few others while the ids are
    fewer than the bits. The bitmap that is broadcast takes 2**bits / 8 bytes at
    most, whatever the number of ids.
    """
    looked, hit = _looked_up(df, ids, bits, key, "left" if but else "inner")
    return looked.where(~F.coalesce(hit, F.lit(False)) if but else hit).select(*df.columns)


def partition_sketch(key_arrays: Iterator[np.ndarray], rows: int, bits: int) -> Iterator[pd.DataFrame]:
    """The count-min sketch of one partition as its counters that are not zero.

    Keys are gathered up to half a million before they are counted, so memory is
    bounded and a cell may appear in several rows; the merge adds them.
    """
    pool, held = [], 0

    def flush():
        keys = np.concatenate(pool)
        for cells in SeenTwice.positions(keys, rows, bits):
            cell, n = np.unique(cells, return_counts=True)
            yield pd.DataFrame({"cell": cell.astype(np.int64), "n": n.astype(np.int64)})

    for keys in key_arrays:
        pool.append(keys)
        held += len(keys)
        if held >= 500_000:
            yield from flush()
            pool, held = [], 0
    if held:
        yield from flush()


SKETCH = "cell long, n long"
