"""Repeated passages: a count-min prefilter, then exact grouping of what is left.

A window is 50 consecutive words. First pass: every partition counts its windows
in a sketch, partition sketches are added up, and a sketch never counts too
little. Windows are counted through an anchor, the smallest hash of the 8-word
runs inside: equal windows have equal anchors, so the anchor's count is never
below the window's, and neighbouring windows share one, so the sketch takes a
twentieth of the counters. Second pass: windows whose count may be two or more
are grouped exactly by a 128-bit hash of their words; none that repeats is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    BASES,
    SKETCH,
    SeenTwice,
    WordHashes,
    Windows,
    among,
    named,
    partition_sketch,
    written,
)
from .copies import TEXT, Firsts, identified

WINDOW, RUN = 50, 8  # words in a window, and in the runs an anchor is chosen from
SKETCH_ROWS, SKETCH_BITS = 2, 27  # 2 x 2**27 cells: 32 MB as bits, in every task


def smallest_inside(runs: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive elements, by doubling."""
    out, have = runs, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


class Hashed:
    """Word, anchor and window hashes of texts."""

    def __init__(self, window: int = WINDOW, run: int = RUN):
        self.window, self.run = window, min(run, window)
        self.words, self.sums = WordHashes(), Windows()

    def anchors(self, hashes: np.ndarray) -> np.ndarray:
        """The anchor of every window, in order."""
        if len(hashes) < self.window:
            return np.empty(0, np.uint64)
        runs = self.sums.of(hashes, self.run)
        return smallest_inside(runs, self.window - self.run + 1)

    def windows(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(self.sums.of(hashes, self.window, base) for base in BASES)


def covered(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of `starts`."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.minimum(starts + window, n), -1)
    return np.cumsum(edges)[:n] > 0


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def measured(rows: DataFrame) -> DataFrame:
    """Words and the hash of all words, for every row."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [t.encode().split() for t in batch.text]
            yield batch[["doc_id", *TEXT]].assign(
                n_words=[len(w) for w in words], sha=[digest(w) for w in words]
            )

    return rows.mapInPandas(
        measure, "doc_id long, mark long, check long, n_chars int, n_words long, sha string"
    )


# --- windows --------------------------------------------------------------------


def repeated_anchors(
    firsts: Firsts, window: int, depth: int = SKETCH_ROWS, bits: int = SKETCH_BITS
) -> SeenTwice:
    """First pass: the merged sketch, as one bit for each cell of two or more."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed = Hashed(window)

        def keys():
            for batch in batches:
                for text in batch.text:
                    anchors = hashed.anchors(hashed.words.of(text.encode().split()))
                    if len(anchors):
                        yield np.unique(anchors)  # once for each document

        return partition_sketch(keys(), depth, bits)

    return SeenTwice.collect(firsts.map(count, SKETCH), depth, bits)


def candidates(firsts: Firsts, seen: SeenTwice, window: int) -> DataFrame:
    """Second pass: documents with windows that may be repeated, and these windows."""
    context = firsts.rows.sparkSession.sparkContext
    shared = context.broadcast((seen.rows, seen.bits, seen.cells))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch, hashed = SeenTwice(*shared.value), Hashed(window)
        for batch in batches:
            out = []
            for doc_id, mark, text in zip(batch.doc_id, batch.mark, batch.text):
                hashes = hashed.words.of(text.encode().split())
                starts = sketch.maybe(hashed.anchors(hashes)).nonzero()[0]
                if len(starts):
                    h1, h2 = hashed.windows(hashes)
                    out.append(
                        (
                            doc_id, mark, text, h1[starts].view(np.int64),
                            (h2[starts] >> np.uint64(32)).astype(np.uint32).view(np.int32),
                            starts.astype(np.int32),
                        )
                    )
            yield pd.DataFrame(out, columns=["doc_id", "mark", "text", "h1", "h2", "start"])

    return firsts.map(
        pick,
        "doc_id long, mark long, text string, h1 array<long>, h2 array<int>, start array<int>",
    )


def repeated_starts(found: DataFrame) -> DataFrame:
    """doc_id, mark and the starts of windows that also start in a smaller doc_id."""
    windows = found.select(
        "doc_id", "mark", F.explode(F.arrays_zip("h1", "h2", "start")).alias("w")
    ).select("doc_id", "mark", "w.h1", "w.h2", "w.start")
    first = (
        windows.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        .select("h1", "h2", "least")
    )
    # Both sides come from one shuffle, so a window that very many documents share
    # stays in one task.
    return (
        windows.join(first, ["h1", "h2"])
        .where("doc_id > least")
        .groupBy("doc_id", "mark")
        .agg(F.collect_list("start").alias("starts"))
    )


def shortened(found: DataFrame, starts: DataFrame, window: int) -> DataFrame:
    """doc_id, mark, left (hash of the words that stay) and removed."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, starts in zip(batch.text, batch.starts):
                words = text.encode().split()
                gone = covered(np.asarray(starts, np.int64), window, len(words))
                out.append((int(gone.sum()), digest([w for w, g in zip(words, gone) if not g])))
            yield batch[["doc_id", "mark"]].assign(
                removed=[n for n, _ in out], left=[sha for _, sha in out]
            )

    return (
        among(found.select("doc_id", "mark", "text"), starts)
        .join(starts, ["doc_id", "mark"])
        .mapInPandas(cut, "doc_id long, mark long, removed long, left string")
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW, bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of `docs`.

    A word goes when a window of `window` words covers it whose words also start
    in a document with a smaller doc_id; windows are judged on the input. A null
    or empty text has no words and keeps none. A null doc_id counts as the
    smallest and stays null. Rows that share a doc_id are never each other's
    earlier document and return each time; other columns are not looked at; an
    empty table gives none.
    """
    rows = identified(docs)
    sizes = written(measured(rows), "sizes")
    firsts = Firsts(rows, sizes)
    seen = repeated_anchors(firsts, window, bits=bits)
    found = written(candidates(firsts, seen, window), "found", "zstd")
    cut = shortened(found, written(repeated_starts(found), "starts"), window)
    least = (
        sizes.groupBy(*TEXT)
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most")
        .select(*TEXT, "least")
    )
    copy = (F.col("doc_id") > F.col("least")) & (F.col("n_words") >= window)
    out = (
        sizes.join(least, TEXT, "left")
        .join(cut, ["doc_id", "mark"], "left")
        .select(
            "doc_id",
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
            F.when(copy, F.lit(digest([]))).otherwise(F.coalesce("left", "sha")).alias("kept_sha256"),
        )
    )
    return named(out)
