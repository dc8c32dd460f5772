"""Best-fit packing planned on a histogram of lengths.

Pieces of one length are alike, so best fit, longest first, is run over counts:
whole groups of equally filled sequences take pieces at once. The plan has rows
"pieces of this length with ranks from here on go to sequences from there on";
a piece finds its place by its rank within its length.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, ranked, texts, written

VOCABULARY = "byte_bpe_50k"
END = 2  # id after each document
LIMIT = 1024


# --- plan -----------------------------------------------------------------------


@dataclass
class Step:
    """Pieces of `length` with ranks from `rank`: `each` to a sequence, from `offset` on."""

    length: int
    rank: int
    count: int
    sequence: int
    each: int
    offset: int


def plan(histogram: dict[int, int], limit: int = LIMIT) -> list[Step]:
    """Best fit over {length: number of pieces}, longest first.

    Groups of sequences with equal room are kept as (first sequence, count), so
    the work and the plan grow with the number of lengths, not of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    steps, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        # Tightest first; a sequence with room for several takes them one after another.
        for free in sorted(r for r in room if r >= length):
            each = free // length
            groups = room.pop(free)
            while groups and left:
                first, count = groups.pop()
                used = min(count, -(-left // each))
                full, rest = divmod(left, each) if used * each > left else (used, 0)
                taken = full * each + rest
                steps.append(Step(length, rank, taken, first, each, limit - free))
                if full:
                    room.setdefault(free - each * length, []).append((first, full))
                if rest:
                    room.setdefault(free - rest * length, []).append((first + full, 1))
                if used < count:
                    groups.append((first + used, count - used))
                left, rank = left - taken, rank + taken
            if groups:
                room.setdefault(free, []).extend(groups)
            if not left:
                break
        if left:
            each = limit // length
            full, rest = divmod(left, each)
            steps.append(Step(length, rank, left, sequences, each, 0))
            if full:
                room.setdefault(limit - each * length, []).append((sequences, full))
            if rest:
                room.setdefault(limit - rest * length, []).append((sequences + full, 1))
            sequences += full + bool(rest)
        room.pop(0, None)
    return steps


def place(pieces: DataFrame, steps: list[Step]) -> DataFrame:
    """Add sequence_id and offset to pieces that have length and rank."""
    table = np.array(
        [(s.length, s.rank, s.sequence, s.each, s.offset) for s in steps], np.int64
    ).reshape(-1, 5)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    # The first row of each length; within it, ranks ascend.
    lengths, starts = np.unique(table[:, 0], return_index=True)
    ends = np.append(starts[1:], len(table))
    shared = pieces.sparkSession.sparkContext.broadcast((table, lengths, starts, ends))

    @F.pandas_udf("sequence_id long, offset long")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        table, lengths, starts, ends = shared.value
        length, rank = length.to_numpy(), rank.to_numpy()
        row = np.empty(len(length), np.int64)
        for one in np.unique(length):
            here = length == one
            i = np.searchsorted(lengths, one)
            ranks = table[starts[i] : ends[i], 1]
            row[here] = starts[i] + np.searchsorted(ranks, rank[here], "right") - 1
        _, first, sequence, each, offset = table[row].T
        nth = rank - first
        return pd.DataFrame(
            {"sequence_id": sequence + nth // each, "offset": offset + nth % each * length}
        )

    return pieces.withColumn("_slot", find("length", "rank")).select(
        *pieces.columns, "_slot.sequence_id", "_slot.offset"
    ).drop("rank")


# --- tokens ---------------------------------------------------------------------


class Ids:
    """Token ids of a text, as the vocabulary's JSON file gives them.

    The same vocabulary exists as ranks, which are read several times faster. A
    text that holds the name of a special token goes through the JSON file, the
    only one of the two that knows special tokens.
    """

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def __call__(self, text: str) -> np.ndarray:
        if any(name in text for name in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return np.array(self.fast.encode_ordinary(text), "<u4")


def cut(n: int, limit: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of n ids: whole pieces, the first one may be shorter."""
    first = n % limit or min(n, limit)
    starts = [0, *range(first, n, limit)]
    return list(zip(starts, [*starts[1:], n]))


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """Every document as ids with END, in pieces of at most `limit`."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = Ids(vocabulary)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                ids = np.append(ids_of(text), np.uint32(END)).astype("<u4")
                rows += [
                    (doc_id, i, a, b - a, zlib.crc32(ids[a:b].tobytes()))
                    for i, (a, b) in enumerate(cut(len(ids), limit))
                ]
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInPandas(encode, PIECES)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A null or empty text is one piece with the end id alone; a null doc_id stays
    null; repeated rows are packed each time; other columns are not looked at;
    an empty table gives none. Bounds: the histogram has `limit` rows.
    """
    cut_up = written(pieces(docs, vocabulary, limit), "pieces")
    histogram = {r.length: r.n for r in cut_up.groupBy("length").agg(F.count("*").alias("n")).collect()}
    numbered = ranked(cut_up, "length", ["doc_id", "piece", "start", "ids_crc32"])
    out = place(numbered, plan(histogram, limit))
    return named(out.select(*cut_up.columns, "sequence_id", "offset"))
