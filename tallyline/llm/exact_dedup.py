"""Exact duplicates by polynomial fingerprints that are put together from chunks.

The fingerprint of a text is its UTF-8 bytes read as digits of a number, modulo
two primes. A chunk's number times base ** (bytes after the chunk) is its share
of the whole, so shares of chunks hashed anywhere add up to the fingerprint of
the whole text. Texts with equal fingerprints are then compared chunk by chunk;
one that differs from its group's keeper moves on to a group of its own kind.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, among, fold, named, texts, written

CHUNK = 1 << 16  # bytes hashed at once
PRIMES = ((1 << 31) - 1, (1 << 31) - 19)
BASES = (1_000_003, 998_244_353)
SLICE = 100_000  # members compared with one copy of their keeper's chunks

ROW, PRINT = ["doc_id", "mark"], ["n", "h1", "h2"]
ROW_ID, ROW_MARK = "__llm_id", "__llm_mark"


_tables: dict[tuple[int, int, int], np.ndarray] = {}


def _powers(base: int, prime: int, size: int) -> np.ndarray:
    key = (base, prime, size)
    if key not in _tables:
        out, power = np.empty(size, np.int64), 1
        for i in range(size - 1, -1, -1):
            out[i] = power
            power = power * base % prime
        _tables[key] = out
    return _tables[key]


def chunk_hash(data: bytes, base: int, prime: int, size: int = CHUNK) -> int:
    """The bytes as digits; a product is below 2**39, so 2**16 of them fit 64 bits."""
    digits = np.frombuffer(data, np.uint8).astype(np.int64)
    return int(digits @ _powers(base, prime, size)[size - len(digits) :]) % prime


def share(data: bytes, after: int, base: int, prime: int, size: int = CHUNK) -> int:
    """What a chunk with `after` bytes behind it adds to the whole fingerprint."""
    return chunk_hash(data, base, prime, size) * pow(base, after, prime) % prime


def _data(docs: DataFrame) -> DataFrame:
    data = texts(docs).select("doc_id", F.encode(fold(F.col("text")), "UTF-8").alias("data"))
    return data.select(
        "doc_id", F.xxhash64("data").alias("mark"), "data",
        F.octet_length("data").cast("long").alias("n"),
    )


def _chunks(docs: DataFrame, chunk_bytes: int, *keep: str) -> DataFrame:
    """A row for each chunk of column `data`; an empty text has one empty chunk."""
    cut = F.transform(
        F.array("data"),  # bound once, not for each chunk
        lambda d: F.transform(
            F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length(d) / chunk_bytes) - 1, F.lit(0))),
            lambda i: F.substring(d, (i * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes)),
        ),
    )[0]
    return docs.select(*keep, F.posexplode(cut).alias("chunk", "part"))


def fingerprints(
    docs: DataFrame, chunk_bytes: int = CHUNK, primes: tuple[int, int] = PRIMES
) -> DataFrame:
    """doc_id, mark, n (bytes), h1, h2 and text_sha256 of every different (doc_id, text).

    `mark` only tells apart texts that share a doc_id.
    """
    if chunk_bytes > CHUNK:
        raise ValueError(f"a chunk has at most {CHUNK} bytes")

    @F.pandas_udf("h1 long, h2 long")
    def shares(part: pd.Series, after: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            {
                name: [share(d, a, base, prime) for d, a in zip(part, after)]
                for name, base, prime in zip(("h1", "h2"), BASES, primes)
            },
            dtype="int64",
        )

    columns = [*ROW, "n", "text_sha256"]
    data = _data(docs).withColumn("text_sha256", F.sha2("data", 256))
    after = F.greatest(F.col("n") - (F.col("chunk") + 1).cast("long") * chunk_bytes, F.lit(0))
    short = (
        data.where(F.col("n") <= chunk_bytes)
        .select(*columns, shares("data", F.lit(0)).alias("h"))
        .select(*columns, "h.*")
    )
    # Chunks of long texts are dealt over all tasks; the sum puts them together.
    parts = (
        _chunks(data.where(F.col("n") > chunk_bytes), chunk_bytes, *columns)
        .dropDuplicates([*columns, "chunk"])
        .select(*columns, shares("part", after).alias("h"))
        .groupBy(*columns)
        .agg(
            (F.sum("h.h1") % primes[0]).alias("h1"),
            (F.sum("h.h2") % primes[1]).alias("h2"),
        )
    )
    return short.unionByName(parts).dropDuplicates([*columns, "h1", "h2"])


def differing(docs: DataFrame, members: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """Members (doc_id, mark, n, h1, h2, keep_id, keep_mark, size) unlike their keeper.

    A chunk of a keeper is copied for every SLICE members, so a large group is
    compared in many tasks. Only texts in groups are shuffled, each of them once.
    """
    is_keeper = (F.col("doc_id") == F.col("keep_id")) & (F.col("mark") == F.col("keep_mark"))
    wanted = members.withColumn("_slices", F.ceil(F.col("size") / SLICE)).drop("size")

    def chunks(of: DataFrame) -> DataFrame:
        # Whose id is not among them is left out before its text is looked at.
        near = _data(among(texts(docs), of.select("doc_id")))
        return _chunks(
            near.join(of, [*ROW, "n"]), chunk_bytes, *ROW, *PRINT, "keep_id", "keep_mark", "_slices"
        )

    key = ["keep_id", "keep_mark", *PRINT, "chunk", "_slice"]
    mine = chunks(wanted.where(~is_keeper)).withColumn(
        "_slice", F.pmod(F.xxhash64(*ROW), F.col("_slices"))
    )
    keeper = chunks(wanted.where(is_keeper)).select(
        "keep_id", "keep_mark", *PRINT, "chunk",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_slices") - 1)).alias("_slice"),
        F.col("part").alias("_kept_part"),
    )
    return (
        mine.join(keeper, key)
        .where(F.col("part") != F.col("_kept_part"))
        .select(*ROW, *PRINT)
        .distinct()
    )


def _keepers(rows: DataFrame, *key: str) -> DataFrame:
    """Groups of more than one with their size and the row that stays."""
    last = F.max(F.struct(*ROW))
    return (
        rows.groupBy(*key)
        .agg(F.count("*").alias("size"), last.alias("_last"))
        .where("size > 1")
        .select(
            *key, "size",
            F.col("_last.doc_id").alias("keep_id"), F.col("_last.mark").alias("keep_mark"),
        )
    )


def _grouped(docs: DataFrame, chunk_bytes: int = CHUNK, primes=PRIMES) -> DataFrame:
    """Every different (doc_id, text) with the row of its group that stays."""
    rows = written(fingerprints(docs, chunk_bytes, primes), "fingerprints")
    rows = rows.withColumn("kind", F.lit(0))
    done, kind = [], 0
    while True:
        members = written(rows.join(_keepers(rows, *PRINT), PRINT).drop("text_sha256"), "members")
        other = written(differing(docs, members, chunk_bytes), "differing")
        if other.isEmpty():
            done.append(rows)
            break
        # Equal fingerprints of different texts: those unlike the keeper go on.
        done.append(rows.join(other, [*ROW, *PRINT], "left_anti"))
        kind += 1
        rows = rows.join(other, [*ROW, *PRINT], "left_semi").withColumn("kind", F.lit(kind))
        rows = written(rows, "fingerprints")
    rows = reduce(DataFrame.unionByName, done)
    # Single texts have no row among the keepers. Both sides come from one shuffle,
    # so the fingerprints of a large group stay in one task.
    key = [*PRINT, "kind"]
    return rows.join(_keepers(rows, *key), key, "left").select(
        *ROW,
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (
            F.col("keep_id").isNull()
            | ((F.col("keep_id") == F.col("doc_id")) & (F.col("keep_mark") == F.col("mark")))
        ).alias("kept"),
        "text_sha256",
    )


def exact_duplicates(
    docs: DataFrame, chunk_bytes: int = CHUNK, primes: tuple[int, int] = PRIMES
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every document.

    Texts are equal when identical after lower-casing A-Z; the row with the
    largest doc_id of a group stays. A null text is an empty one. A null doc_id
    counts as the smallest id and stays null. Repeated rows (same doc_id, same
    text) are one document and return once; a doc_id with several texts returns
    once for each. Other columns are not looked at. An empty table gives none.
    """
    return named(_grouped(docs, chunk_bytes, primes).drop("mark"), "keep_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; cases as above."""
    kept = _grouped(docs).where("kept").select(
        F.col("doc_id").alias(ROW_ID), F.col("mark").alias(ROW_MARK)
    )
    marked = docs.withColumns(
        {
            ROW_ID: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
            ROW_MARK: F.xxhash64(
                F.encode(fold(F.coalesce(F.col("text"), F.lit(""))), "UTF-8")
            ),
        }
    )
    key = [ROW_ID, ROW_MARK]
    return marked.join(kept, key, "left_semi").dropDuplicates(key).select(*docs.columns)
