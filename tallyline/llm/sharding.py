"""Contiguous shards of equal texts with the smallest possible largest shard.

Texts are ordered by a hash; the rows of one text form an atomic group. A binary
search finds the smallest capacity with which greedy filling needs no more than
the given number of shards. The search runs on segments of the order, each known
by its total. A segment in which a cut would fall is split by further bits of
the hash, until all cuts that matter fall between single groups: the result is
exact, and the driver holds a bounded number of segments however many groups
there are.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, ranked, texts, written

SHARDS = 16
BITS = 63  # a group's place in the order
FIRST, SPLIT = 12, 8  # bits of the first segments and of each further split


@dataclass(frozen=True)
class Segment:
    """Groups whose place has the same upper bits: `low` is the least place."""

    low: int
    bits: int  # upper bits that are fixed
    groups: int
    size: int


class Order:
    """Segments in order, with running totals."""

    def __init__(self, segments: list[Segment]):
        self.segments = sorted(segments, key=lambda s: s.low)
        self.ends = [0]
        for s in self.segments:
            self.ends.append(self.ends[-1] + s.size)
        self.total = self.ends[-1]

    def reach(self, start: int, capacity: int) -> int:
        """Number of segments before the furthest cut with at most `capacity` from `start`."""
        return bisect_right(self.ends, self.ends[start] + capacity) - 1

    def greedy(self, capacity: int, shards: int) -> list[int]:
        """Cuts of greedy filling, as many as `shards` allows."""
        cuts, at = [], 0
        for _ in range(shards):
            at = self.reach(at, capacity)
            cuts.append(at)
        return cuts

    def fits(self, capacity: int, shards: int) -> bool:
        return self.greedy(capacity, shards)[-1] == len(self.segments)

    def smallest(self, shards: int) -> int:
        low = max([-(-self.total // shards), *(s.size for s in self.segments)])
        high = max(low, self.total)
        while low < high:
            middle = (low + high) // 2
            if self.fits(middle, shards):
                high = middle
            else:
                low = middle + 1
        return low

    def even(self, capacity: int, shards: int) -> tuple[list[int], set[int]]:
        """Cuts within `capacity`, each nearest to an equal share of what is left.

        Also the segments that a choice fell into: with smaller ones the choice
        could be another.
        """
        # Shard k may end no earlier than latest[k], or the rest would not fit.
        latest, at = [], len(self.segments)
        for _ in range(shards - 1):
            latest.append(at := bisect_left(self.ends, self.ends[at] - capacity))
        cuts, touched, at = [], set(), 0
        for k, least in enumerate(reversed(latest)):
            goal = self.ends[at] + (self.total - self.ends[at]) / (shards - k)
            most = self.reach(at, capacity)
            under = max(bisect_right(self.ends, goal) - 1, at)
            near = under
            if under < len(self.segments) and self.ends[under + 1] - goal < goal - self.ends[under]:
                near = under + 1
            touched |= {under, most, least - 1}
            at = min(max(near, least, at), most)
            cuts.append(at)
        return cuts, touched

    def undecided(self, shards: int) -> tuple[int, list[int], list[Segment]]:
        """Capacity and cuts so far, and the segments that have to be split to be sure."""
        capacity = self.smallest(shards)
        cuts, touched = self.even(capacity, shards)
        # That a smaller capacity fails is sure when its cuts fall between groups.
        touched |= set(self.greedy(capacity - 1, shards))
        touched |= {i for i, s in enumerate(self.segments) if s.size >= capacity}
        # So is a choice of the last segments: what lies on either side counts too.
        split = [
            self.segments[i]
            for i in sorted(touched)
            if 0 <= i < len(self.segments) and self.segments[i].groups > 1
        ]
        return capacity, cuts, split


def _segments(groups: DataFrame, bits: Column, known: Callable | None = None) -> list[Segment]:
    """Totals of segments of the given number of upper bits."""
    low = F.call_function("shiftright", "place", F.lit(BITS) - bits)
    rows = (
        groups.select(low.alias("low"), bits.alias("bits"), "size")
        .groupBy("low", "bits")
        .agg(F.count("*").alias("groups"), F.sum("size").alias("size"))
        .collect()
    )
    return [Segment(r.low << (BITS - r.bits), r.bits, r.groups, r.size) for r in rows]


def best_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity and the places where shards 1, 2, ... begin.

    `groups` has one row for each group: place (0 to 2**63 - 1) and size.
    """
    segments = _segments(groups, F.lit(FIRST))
    while True:
        order = Order(segments)
        capacity, cuts, split = order.undecided(shards)
        if not split:
            ends = [s.low for s in order.segments] + [1 << BITS]
            return capacity, [ends[c] for c in cuts]
        # At most a few dozen segments a round, each into 2**SPLIT at most.
        pick = [(s.low, s.low + (1 << (BITS - s.bits)) - 1, min(s.bits + SPLIT, BITS)) for s in split]
        inside = reduce(
            lambda a, b: a | b, [F.col("place").between(low, high) for low, high, _ in pick]
        )
        bits = F.coalesce(
            *[F.when(F.col("place").between(low, high), F.lit(b)) for low, high, b in pick]
        )
        gone = set(split)
        segments = [s for s in order.segments if s not in gone]
        segments += _segments(groups.where(inside), bits)


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of `docs`.

    The law is `bytes`: no assignment of whole groups in this order has a smaller
    largest shard, and within that bound shards are as even as the groups allow.
    A group is all rows with the same text; a null text counts as an empty one
    (size 1). A group is never cut, so one that holds a third of all bytes fills
    a shard alone. Slots are gapless from 0 in each shard. A null doc_id stays
    null; repeated rows get a slot each; other columns are not looked at; an
    empty table gives none.
    """
    rows = written(
        texts(docs).select(
            "doc_id",
            (F.octet_length("text") + 1).cast("long").alias("size"),
            F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
            F.call_function("shiftrightunsigned", F.xxhash64("text"), F.lit(1)).alias("place"),
        ),
        "sizes",
    )
    groups = written(rows.groupBy("place").agg(F.sum("size").alias("size")), "groups")
    _, cuts = best_cuts(groups, shards)
    number = reduce(
        lambda a, b: a + b, [(F.col("place") >= c).cast("int") for c in cuts if c < 1 << BITS], F.lit(0)
    )
    placed = rows.withColumn("shard", number)
    out = ranked(placed, "shard", ["place", "doc_id", "size", "text_crc32"])
    return named(
        out.select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            F.col("rank").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        )
    )
