"""Near duplicates by an exact Jaccard join with adaptive multi-match prefixes.

A document is its set of hashed 5-word shingles in one global order, rare ones
first. Two sets of similarity 0.8 share a shingle among the first 0.2 n + 1 of
each, and share l among the first 0.2 n + l: a longer prefix may ask for more
matches. Each document takes the l with the smallest estimated number of
candidates, and a pair is held to the smaller l of the two.

Shingles found in the same documents, as those of a passage are, form one list
with their number as its weight, so a shared passage is one row of a pair and not
one for each of its shingles. Pairs must also pass signs, bit vectors as long as
the sets, which tell apart all that are not nearly similar enough.

Components are wanted, not pairs. Copies of a text stand aside at first. Then
every document is compared with the most typical document of each of its prefix
shingles, which joins large groups with about as many comparisons as members.
Only pairs whose ends are still in different components go through the join, so
no link between components is lost and a group's own pairs are never listed.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    SKETCH,
    SeenTwice,
    WordHashes,
    Windows,
    among,
    chosen,
    named,
    partition_sketch,
    row_key,
    written,
)
from .components import components
from .copies import TEXT, Firsts, identified

SHINGLE, PERCENT = 5, 80
# Cost of a candidate beside a list entry: few candidates pass the bounds on sizes
# and places and have their texts compared.
CANDIDATE = 0.25
LONGEST = 8  # extra prefix shingles, and shared ones asked for, at most
SKETCH_ROWS, SKETCH_BITS = 1, 27  # 16 MB as bits, in every task
# The order's rare and frequent shingles are told apart on this many documents;
# the order steers the cost only, results are exact with any.
ORDER_DOCS, ORDER_LEAST, ORDER_MOST = 10_000, 3, 200_000


class Shingles:
    """Sets of shingle hashes of texts whose A-Z are lower-cased."""

    def __init__(self, size: int = SHINGLE):
        self.size, self.words, self.sums = size, WordHashes(), Windows()

    def of(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if not words:
            return np.empty(0, np.uint64)
        return np.unique(self.sums.of(self.words.of(words), min(self.size, len(words))))


# Bits of a sign: as many as shingles, to the next power of two. Signs of sets larger
# than the most tell fewer pairs apart, and never wrongly.
LEAST_BITS, MOST_BITS = 512, 8192


def sign(shingles: np.ndarray) -> np.ndarray:
    """Each bit says whether an odd number of shingles falls on it.

    Two signs differ in at most as many bits as their sets have shingles apart.
    The two halves of a sign, added up, are the sign of half as many bits.
    """
    bits = LEAST_BITS
    while bits < min(len(shingles), MOST_BITS):
        bits *= 2
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def near_signs(a: str, b: str, percent: int) -> Column:
    """False for pairs whose signs differ in more bits than the similarity allows.

    For pairs of near sizes, whose signs are of one length or one twice the other.
    """
    x, y = F.col(f"{a}.sign"), F.col(f"{b}.sign")

    def at_most(sign: Column, other: Column) -> Column:
        half = F.size(other)
        halves = F.zip_with(
            F.slice(sign, F.lit(1), half), F.slice(sign, half + 1, half),
            lambda p, q: p.bitwiseXOR(q),
        )
        return F.when(F.size(sign) > half, halves).otherwise(sign)

    bits = F.zip_with(at_most(x, y), at_most(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    apart = F.aggregate(bits, F.lit(0), lambda total, n: total + n)
    both = F.col(f"{a}.n") + F.col(f"{b}.n")
    return apart * (100 + percent) <= (100 - percent) * both


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def prefix(
    shingles: np.ndarray, common: tuple[np.ndarray, np.ndarray], percent: int, longest: int
) -> tuple[np.ndarray, np.ndarray]:
    """The longest prefix and the l from which each of its shingles is in it.

    Order: frequency in the order's sample (0 when not listed), then hash.
    common: listed hashes, ascending, and their frequencies.
    """
    n = len(shingles)
    keys, frequency = common
    need = least_overlap(n, percent)
    size = n - need + min(longest, need)
    ordered = shingles
    if len(keys):
        at = np.searchsorted(keys, shingles)
        at[at == len(keys)] = 0
        listed = keys[at] == shingles
        if listed.any():
            late = shingles[listed]
            late = late[np.lexsort((late, frequency[at[listed]]))]
            ordered = np.concatenate([shingles[~listed], late])
    return ordered[:size], levels(n, size, percent)


def levels(n: int, size: int, percent: int) -> np.ndarray:
    """The l from which each place of a prefix of `size` is in it, for a set of n."""
    return np.maximum(np.arange(1, size + 1) - (n - least_overlap(n, percent)), 1).astype(np.int32)


# --- passes over the texts ------------------------------------------------------


def common_shingles(
    rows: DataFrame, sizes: DataFrame, shingle: int, docs: int = ORDER_DOCS, least: int = ORDER_LEAST,
    most: int = ORDER_MOST,
) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in at least `least` of `docs` different texts, `most` of them at most."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = Shingles(shingle)
        pool, held = [], 0
        for batch in batches:
            for text in batch.text:
                pool.append(sets.of(text))
                held += len(pool[-1])
                if held > 1_000_000:
                    yield tally(pool)
                    pool, held = [], 0
        if pool:
            yield tally(pool)

    def tally(pool: list[np.ndarray]) -> pd.DataFrame:
        key, n = np.unique(np.concatenate(pool), return_counts=True)
        return pd.DataFrame({"key": key.view(np.int64), "n": n.astype(np.int64)})

    chosen = (
        sizes.groupBy("mark").agg(F.min("doc_id").alias("doc_id"))
        .orderBy(F.xxhash64("mark", F.lit(1))).limit(docs)
    )
    got = (
        rows.join(F.broadcast(chosen), ["doc_id", "mark"], "left_semi")
        .select("text")
        .mapInPandas(count, "key long, n long")
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least)
        .orderBy(F.desc("n"), "key")
        .limit(most)
        .collect()
    )
    keys = np.array([r.key for r in got], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([r.n for r in got], np.int64)[order]


def column(values: list, batch: pd.DataFrame) -> pd.Series:
    """Values, arrays among them, as a column of the batch, which may be empty."""
    return pd.Series(values, batch.index, dtype=object)


def described(firsts: Firsts, common, shingle: int, percent: int, longest: int) -> DataFrame:
    """Size, prefix and sign of every set, and its text: sets are hashed here only."""
    shared = firsts.rows.sparkSession.sparkContext.broadcast(common)

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = Shingles(shingle)
        for batch in batches:
            found = [sets.of(text) for text in batch.text]
            keys = [prefix(f, shared.value, percent, longest)[0].view(np.int64) for f in found]
            yield batch[["doc_id", "mark", "text"]].assign(
                n=column([len(f) for f in found], batch),
                key=column(keys, batch),
                sign=column([sign(f) for f in found], batch),
            )

    return firsts.map(
        describe,
        "doc_id long, mark long, text string, n int, key array<long>, sign array<long>",
    )


def repeated_prefixes(every: DataFrame, depth: int, bits: int) -> SeenTwice:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = (np.asarray(key, np.int64).view(np.uint64) for b in batches for key in b.key)
        return partition_sketch(keys, depth, bits)

    return SeenTwice.collect(every.select("key").mapInPandas(count, SKETCH), depth, bits)


def shared_prefixes(every: DataFrame, seen: SeenTwice, percent: int) -> DataFrame:
    """Sets with a prefix shingle that another may share, and those shingles only."""
    shared = every.sparkSession.sparkContext.broadcast((seen.rows, seen.bits, seen.cells))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch = SeenTwice(*shared.value)
        for batch in batches:
            keys, level = [], []
            for key, n in zip(batch.key, batch.n):
                key = np.asarray(key, np.int64)
                may = sketch.maybe(key.view(np.uint64))
                keys.append(key[may])
                level.append(levels(n, len(key), percent)[may])
            some = np.array([len(key) > 0 for key in keys], bool)
            yield batch.assign(key=column(keys, batch), level=column(level, batch))[some]

    return every.select("doc_id", "mark", "n", "key", "sign").mapInPandas(
        pick,
        "doc_id long, mark long, n int, key array<long>, level array<int>, sign array<long>",
    )


def signs(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "mark", "n", "sign")


# --- candidates -----------------------------------------------------------------


def near_sizes(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can reach the similarity."""
    return (100 * F.least(a, b) >= percent * F.greatest(a, b))


def postings(found: DataFrame, longest: int) -> DataFrame:
    """(list, doc_id, mark, n, df, upto): a list stands for all shingles of the same documents.

    Lists are told apart by hashes of their documents; lists taken for one give more
    candidates, never fewer. `df` is the number of documents, and the i-th number of
    `upto` says how many shingles of the list the document's prefix for i matches holds.
    As prefixes follow one order, two documents share the smaller of their numbers.
    """
    each = found.select(
        "doc_id", "mark", "n", F.explode(F.arrays_zip("key", "level")).alias("p")
    ).select("p.key", "doc_id", "mark", "n", "p.level")
    several = (
        each.groupBy("key")
        .agg(
            F.count("*").alias("df"),
            F.bit_xor(F.xxhash64("doc_id", "mark")).alias("one"),
            F.bit_xor(F.xxhash64("mark", "doc_id")).alias("two"),
        )
        .where("df > 1")
        .select("key", "df", F.xxhash64("df", "one", "two").alias("list"))
    )
    # Written, so that Spark can split a shingle of very many documents in the join.
    several = written(several, "several")
    upto = [F.count_if(F.col("level") <= i).cast("int") for i in range(1, longest + 1)]
    return (
        each.join(several, "key")
        .groupBy("doc_id", "mark", "list")
        .agg(F.max("n").alias("n"), F.max("df").alias("df"), F.array(*upto).alias("upto"))
    )


def with_leaders(listed: DataFrame, percent: int) -> DataFrame:
    """Each document with the leader of each of its lists.

    The leader is the document with the most shared prefix shingles: the least
    edited of a group of copies, and so the one most alike to all of them.
    """
    own = listed.groupBy("doc_id", "mark").agg(F.sum(F.element_at("upto", -1)).alias("shared"))
    leader = (
        listed.join(own, ["doc_id", "mark"])
        .groupBy("list")
        .agg(F.max(F.struct("shared", "doc_id", "mark", "n")).alias("l"))
    )
    return (
        listed.join(written(leader, "leaders"), "list")
        .where("doc_id <> l.doc_id")
        .where(near_sizes(F.col("n"), F.col("l.n"), percent))
        .select(
            F.col("l.doc_id").alias("a"), F.col("l.mark").alias("a_mark"),
            F.col("doc_id").alias("b"), F.col("mark").alias("b_mark"),
        )
        .distinct()
    )


def alike(pairs: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """The pairs whose signs allow the similarity: the others need no texts."""
    a, b = signs(found).alias("x"), signs(found).alias("y")
    return (
        pairs.join(b, (F.col("b") == F.col("y.doc_id")) & (F.col("b_mark") == F.col("y.mark")))
        .join(a, (F.col("a") == F.col("x.doc_id")) & (F.col("a_mark") == F.col("x.mark")))
        .where(near_signs("x", "y", percent))
        .select("a", "a_mark", "b", "b_mark")
    )


def matches_asked(listed: DataFrame, longest: int) -> DataFrame:
    """Add `l`, the matches asked of a document, at the smallest estimated cost, and
    `total`, the listed shingles in its prefix for l.

    Prefix l meets the documents of its lists, and at most an l-th of what it shares
    with them as candidates.
    """
    others = F.col("df") - 1
    costs = []
    for i in range(1, longest + 1):
        held = F.get("upto", F.lit(i - 1))
        costs.append(F.sum(F.when(held > 0, others * (1 + CANDIDATE * held / i))))
    # Sets of few shingles may not be asked for more matches than they must share.
    top = F.max("n")
    best = None
    for i in range(longest, 0, -1):
        cost = F.when((F.lit(i) == 1) | (top >= 2 * i), F.coalesce(costs[i - 1], F.lit(0.0)))
        total = F.sum(F.get("upto", F.lit(i - 1)))
        pair = F.struct(
            F.coalesce(cost, F.lit(float("inf"))).alias("cost"), F.lit(i).alias("l"),
            total.alias("total"),
        )
        best = pair if best is None else F.least(pair, best)
    chosen = listed.groupBy("doc_id", "mark").agg(best.alias("best"))
    return listed.join(
        chosen.select("doc_id", "mark", F.col("best.l").alias("l"), F.col("best.total").alias("total")),
        ["doc_id", "mark"],
    )


def across(
    listed: DataFrame, found: DataFrame, roots: DataFrame, percent: int, longest: int
) -> DataFrame:
    """Pairs of documents in different components that share enough prefix shingles."""
    placed = listed.join(
        roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left"
    ).withColumn("root", F.coalesce("root", "doc_id"))
    mixed = (
        placed.groupBy("list")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low < high")
        .select("list")
    )
    asked = matches_asked(placed.join(written(mixed, "mixed"), "list"), longest)
    asked = asked.where(F.get("upto", F.col("l") - 1) > 0).drop("df")
    asked = asked.join(signs(found).drop("n"), ["doc_id", "mark"])
    asked = written(asked, "asked")
    a, b = asked.alias("a"), asked.alias("b")
    least = F.least("a.l", "b.l")
    # Beyond the prefixes, no more than the longer rest can be shared; what the two
    # sizes ask for above that has to be shared inside.
    both = F.ceil(percent * (F.col("a.n") + F.col("b.n")) / (100 + percent))
    more = both - F.ceil(percent * F.greatest("a.n", "b.n") / 100)
    shared = F.least(F.get("a.upto", least - 1), F.get("b.upto", least - 1))
    return (
        a.join(
            b,
            (F.col("a.list") == F.col("b.list"))
            & (F.col("a.doc_id") < F.col("b.doc_id"))
            & (F.col("a.root") != F.col("b.root"))
            & near_sizes(F.col("a.n"), F.col("b.n"), percent)
            & (shared > 0)
            & (F.least("a.total", "b.total") >= more + least)
            & near_signs("a", "b", percent),
        )
        .groupBy(
            F.col("a.doc_id").alias("a"), F.col("a.mark").alias("a_mark"),
            F.col("b.doc_id").alias("b"), F.col("b.mark").alias("b_mark"),
        )
        .agg(F.sum(shared).alias("shared"), F.max(more + least).alias("enough"))
        .where("shared >= enough")
        .drop("shared", "enough")
    )


def verified(pairs: DataFrame, every: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets have the similarity."""
    pairs = written(pairs, "pairs")

    def text(end: str) -> DataFrame:
        """Texts of this end of the pairs: the others need not be shuffled."""
        ends = pairs.select(F.col(end).alias("doc_id"))
        return among(every.select("doc_id", "mark", "text"), ends).select(
            F.col("doc_id").alias(end), F.col("mark").alias(f"{end}_mark"),
            F.col("text").alias(f"{end}_text"),
        )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets, recent = Shingles(shingle), OrderedDict()

        def known(doc_id, mark, text):
            key = (doc_id, mark)
            if key not in recent:
                if len(recent) > 50:
                    recent.popitem(last=False)
                recent[key] = sets.of(text)
            return recent[key]

        for batch in batches:
            keep = []
            for row in batch.itertuples():
                x = known(row.a, row.a_mark, row.a_text)
                y = known(row.b, row.b_mark, row.b_text)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.loc[keep, ["a", "b"]]

    # The smaller end's texts join last: rows come sorted by it, so its set is kept.
    sides = pairs.join(text("b"), ["b", "b_mark"]).join(text("a"), ["a", "a_mark"])
    return sides.mapInPandas(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, longest: int = LONGEST,
    bits: int = SKETCH_BITS,
) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of `docs`.

    Documents link when 100 * shared >= percent * all of their different
    shingles (words in lower case A-Z; a shorter text is one shingle).
    component_id is the smallest doc_id reachable over links. A null or empty
    text, or one without words, has no shingles and links with nothing. A null
    doc_id counts as the smallest id and stays null, also as component_id. Rows
    that share a doc_id are one node and return each time; other columns are not
    looked at; an empty table gives none.
    """
    # Copies are told by the text as it stands; those in other case meet in the join.
    rows = identified(docs)
    sizes = written(rows.drop("text"), "sizes")
    firsts = Firsts(rows, sizes)
    common = common_shingles(rows, sizes, shingle)
    every = written(described(firsts, common, shingle, percent, longest), "sets", "zstd")
    seen = repeated_prefixes(every, SKETCH_ROWS, bits)
    found = written(shared_prefixes(every, seen, percent), "found", "zstd")
    listed = written(postings(found, longest), "listed")
    led = alike(with_leaders(listed, percent), found, percent)
    near = written(verified(led, every, shingle, percent), "near")
    roots = components(near)
    rest = written(
        verified(across(listed, found, roots, percent, longest), every, shingle, percent), "rest"
    )
    # Each row with the first document of its text, whose set is its own too.
    least = sizes.groupBy(*TEXT).agg(F.min("doc_id").alias("least"))
    n = every.select(F.col("doc_id").alias("least"), "mark", "n")
    placed = written(
        sizes.join(least, TEXT).join(n, ["least", "mark"]).select("doc_id", "least", "n"), "placed"
    )
    copies = placed.where("n > 0 AND doc_id > least").select(
        F.col("least").alias("a"), F.col("doc_id").alias("b")
    )
    final = components(near.unionByName(rest).unionByName(copies))
    out = placed.join(final.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("root", "doc_id").alias("component_id"),
    )
    return named(out, "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """Of every component the row with the smallest doc_id, with all its columns.

    Rows without shingles all stay. Cases as above; rows that share a doc_id
    stay together, rows without one are told apart by their texts.
    """
    return chosen(
        docs,
        near_duplicates(docs.withColumn("doc_id", row_key())).where("component_id = doc_id"),
    )
