"""How the sources of a language differ in the terms they use.

Terms are counted under digests of 64 bits: a task writes its counts, and each term
once, and what is shuffled and aggregated are digests and numbers. Terms are
read again for digests that are frequent enough only, as the smallest and largest term
of each: where these differ, several terms share the digest, and its counts are split
by term. The terms of the result are joined back at the end.

All arithmetic is in whole numbers of 64 bits, exact while a language has fewer
than nine thousand million million occurrences of kept terms.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import among, arrow_batches, written

LEAST_DOCUMENTS, TOP = 10, 10
BITS = 64  # of a digest
# What a task gathers before it hands it on: distinct terms of rows, where a group counts
# as PER_GROUP of them, or bytes of text.
GATHERED, PER_GROUP, GATHERED_BYTES = 2_000_000, 64, 64 << 20
LINES = 1 << 16  # lines handed on at once
BATCH_BYTES = "4m"  # of rows handed to Python at once
BLOCK = 64  # sources compared at once
SALTS = 16  # slices of a source's or language's rows in joins with small tables

# Bytes of a term, lower-cased; everything else is a space. Runs of these bytes are
# the runs of letters A-Z, a-z and characters beyond ASCII.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
TERM = ["digest", "exact"]  # exact: the term where its digest has several, else empty


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


# --- counts ---------------------------------------------------------------------


class Gathered:
    """Occurrences of terms in the groups of some rows, as numbers of groups and terms."""

    def __init__(self):
        self.groups = defaultdict(count().__next__)
        self.terms = defaultdict(count().__next__)
        self._pairs = []  # by group: numbers and times of its rows' distinct terms, row after row
        self._size = self._bytes = 0

    def add(self, lang: str, source: str, text: str) -> None:
        data = text.encode()
        found = data.translate(TERM_BYTES).split()
        if not found:
            return
        numbers = np.fromiter(map(self.terms.__getitem__, found), np.int32, len(found))
        number, times = np.unique(numbers, return_counts=True)
        group = self.groups[lang, source]
        if group == len(self._pairs):
            self._pairs.append((array("i"), array("i")))
        for held, more in zip(self._pairs[group], (number, times.astype(np.int32))):
            held.frombytes(more.tobytes())
        self._size += len(number)
        self._bytes += len(data)

    def full(self) -> bool:
        return self._size + PER_GROUP * len(self.groups) >= GATHERED or self._bytes >= GATHERED_BYTES

    def _parts(self) -> Iterator[list[int]]:
        """Groups that are counted together: whole ones, with LINES terms of rows or more."""
        part, size = [], 0
        for group, (number, _) in enumerate(self._pairs):
            part.append(group)
            size += len(number)
            if size >= LINES:
                yield part
                part, size = [], 0
        if part:
            yield part

    def batches(self, bits: int, spelled: bool) -> Iterator[pa.RecordBatch]:
        """One line for each group and term, LINES at most in a batch; a term stands in its first line, or in all."""
        digests = np.fromiter(map(xxhash.xxh3_64_intdigest, self.terms), np.uint64, len(self.terms))
        digests = (digests >> np.uint64(64 - bits)).view(np.int64)
        terms = pa.array(list(self.terms), pa.binary()).cast(pa.string())
        langs, sources = (pa.array(list(names), pa.string()) for names in zip(*self.groups))
        shown = np.zeros(len(self.terms), bool)
        for part in self._parts():
            pairs = [[np.frombuffer(held, np.int32) for held in self._pairs[g]] for g in part]
            key = np.repeat(np.array(part, np.int64) << 32, [len(n) for n, _ in pairs])
            key |= np.concatenate([n for n, _ in pairs])
            order = np.argsort(key, kind="stable")
            key = key[order]
            starts = np.flatnonzero(np.diff(key, prepend=-1))
            held = np.diff(starts, append=len(key))
            n = np.add.reduceat(np.concatenate([t for _, t in pairs])[order], starts, dtype=np.int64)
            key = key[starts]
            number = key & 0xFFFFFFFF
            without = np.full(len(number), not spelled)
            distinct, first = np.unique(number, return_index=True)
            without[first[~shown[distinct]]] = False
            shown[distinct] = True
            for at in range(0, len(key), LINES):
                here = slice(at, at + LINES)
                group = pa.array(key[here] >> 32)
                yield pa.RecordBatch.from_arrays(
                    [
                        langs.take(group), sources.take(group),
                        pa.array(digests[number[here]]),
                        terms.take(pa.array(number[here], mask=without[here])),
                        pa.array(n[here]), pa.array(held[here]),
                    ],
                    names=["lang", "source", "digest", "term", "n", "docs"],
                )


def _gather(batches: Iterator[pa.RecordBatch], bits: int, spelled: bool) -> Iterator[pa.RecordBatch]:
    held = Gathered()
    for batch in batches:
        for lang, source, text in zip(*[c.to_pylist() for c in batch.columns]):
            held.add(lang, source, text)
            if held.full():
                yield from held.batches(bits, spelled)
                held = Gathered()
    if held.terms:
        yield from held.batches(bits, spelled)


def task_counts(docs: DataFrame, bits: int = BITS, spelled: bool = False) -> DataFrame:
    """lang, source, digest, term, n, docs: occurrences and documents, from each task.

    A task writes a term out in one line and its digest alone in the others, unless
    terms are wanted `spelled` in each.
    """
    arrow_batches(docs.sparkSession, size=BATCH_BYTES)
    rows = docs.select(_filled("lang"), _filled("source"), _filled("text"))
    return rows.mapInArrow(
        lambda batches: _gather(batches, bits, spelled),
        "lang string, source string, digest long, term string, n long, docs long",
    )


def term_counts(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, bits: int = BITS
) -> tuple[DataFrame, DataFrame]:
    """Counts of kept terms (lang, source, digest, exact, n), and (digest, term) of all kept ones."""
    tasks = written(task_counts(docs, bits), "task_terms", "zstd")
    # No strings of terms here: the columnar file is read without that column.
    counts = written(
        tasks.groupBy("lang", "source", "digest").agg(
            F.sum("n").alias("n"), F.sum("docs").alias("docs")
        ),
        "digest_counts",
    )
    often = F.sum("docs") >= least_documents
    # A digest is as frequent as its terms together, so no frequent term is missing.
    frequent = written(
        counts.groupBy("lang", "digest").agg(often.alias("often")).where("often")
        .select("digest").distinct(),
        "frequent_digests",
    )
    terms = written(
        among(tasks.select("digest", "term").where("term IS NOT NULL"), frequent, key="digest")
        .groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("last"))
        .join(frequent, "digest", "left_semi"),
        "digest_terms",
    )
    single, several = terms.where("term = last"), terms.where("term < last").select("digest")
    # Only counts of frequent digests go on.
    counted = counts.join(single.select("digest"), "digest", "left_semi").select(
        "lang", "source", "digest", F.lit("").alias("exact"), "n", "docs"
    )
    if not several.isEmpty():
        # So rare with 64 bits that the texts are read again for it.
        split = (
            among(task_counts(docs, bits, spelled=True), several, key="digest")
            .join(several, "digest", "left_semi")
            .groupBy("lang", "source", "digest", F.col("term").alias("exact"))
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        )
        counted = counted.unionByName(split)
    kept = written(
        counted.groupBy("lang", *TERM).agg(often.alias("often")).where("often").drop("often"),
        "kept_terms",
    )
    counted = counted.drop("docs").join(kept, ["lang", *TERM], "left_semi")
    return written(counted, "kept_counts"), single.select("digest", "term")


# --- shares and their distance --------------------------------------------------


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 terms)), three decimal digits at a time."""
    below = total + F.lit(2) * terms
    value, rest = F.lit(0).cast("long"), n + F.lit(2)
    for _ in range(3):
        rest = rest * F.lit(1000)
        value = value * F.lit(1000) + _div(rest, below)
        rest = rest % below
    return value + F.lit(1)


def _div(a: Column, b: Column) -> Column:
    """Whole-number division of numbers that are not negative."""
    return F.call_function("div", a, b)


def distance(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def group_table(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """One row for each group: lang, source, slot in its language, total, terms, all_total, none.

    `terms` are the kept terms of the language, `all_total` its occurrences of them,
    `none` the share of a term that the group never has (null without kept terms).
    """
    groups = docs.select(_filled("lang"), _filled("source")).distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = (
        counts.groupBy("lang", *TERM).agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("all_total"))
    )
    slot = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    table = (
        groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select(
            "lang", "source", slot.alias("slot"),
            *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("total", "terms", "all_total")],
        )
    )
    none = share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))
    return table.withColumn("none", F.when(F.col("terms") > 0, none))


def salted(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Join on keys with few values, each value's rows dealt over slices by digest."""
    slices = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return (
        rows.withColumn("_salt", F.pmod(F.xxhash64(*TERM), F.lit(SALTS)).cast("int"))
        .join(small.withColumn("_salt", slices), [*keys, "_salt"]).drop("_salt")
    )


# --- top terms of each group ----------------------------------------------------


def top_terms(counts: DataFrame, groups: DataFrame, names: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank: terms more frequent in the group than in its language."""
    in_lang = counts.groupBy("lang", *TERM).agg(F.sum("n").alias("all_n"))
    rows = salted(counts.join(in_lang, ["lang", *TERM]), groups, ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("all_n"), F.col("all_total"), F.col("terms"))
    valued = rows.select("lang", "source", *TERM, p.alias("p"), q.alias("q")).where("p > q")
    valued = valued.select("lang", "source", *TERM, distance(F.col("p"), F.col("q")).alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    # Terms that tie with the last one stay until their strings decide.
    best = valued.withColumn("_rank", F.rank().over(by_value)).where(F.col("_rank") <= top)
    best = best.join(names, "digest", "left").withColumn(
        "item", F.when(F.col("exact") != "", F.col("exact")).otherwise(F.col("term"))
    )
    by_item = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        best.select("lang", "source", "item", "value")
        .withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= top)
    )


# --- sources against each other -------------------------------------------------


def _blocks(counts: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """Each term's shares in a block of sources: lang, block, digest, exact, shares.

    shares holds the places (at) and shares (p) of the sources that have the term,
    `block` of them at most.
    """
    p = share(F.col("n"), F.col("total"), F.col("terms"))
    return (
        salted(counts, groups, ["lang", "source"])
        .select(
            "lang", F.expr(f"slot div {block}").cast("int").alias("block"), *TERM,
            F.struct((F.col("slot") % block).cast("int").alias("at"), p.alias("p")).alias("one"),
        )
        .groupBy("lang", "block", *TERM).agg(F.collect_list("one").alias("all"))
        .select(
            "lang", "block", *TERM,
            F.struct(F.col("all.at").alias("at"), F.col("all.p").alias("p")).alias("shares"),
        )
    )


SUMS = "lang string, a int, b int, value long, seen long"


def _compare(batches: Iterator[pd.DataFrame], block: int) -> Iterator[pd.DataFrame]:
    """Sum the distances of each pair of sources over the terms of the batches."""
    sums = {}

    def flush() -> Iterator[pd.DataFrame]:
        for (lang, one, other), (total, seen) in sums.items():
            a, b = np.divmod(np.arange(total.size), total.shape[1])
            yield pd.DataFrame(
                {
                    "lang": lang, "a": a + one * block, "b": b + other * block,
                    "value": total.ravel(), "seen": seen,
                }
            )
        sums.clear()

    def dense(none: np.ndarray, at: pd.Series, p: pd.Series) -> np.ndarray:
        """Terms by sources: the given share, or that of a term the source never has."""
        out = np.tile(none, (len(at), 1))
        out[np.repeat(np.arange(len(at)), at.map(len)), np.concatenate(at.array)] = np.concatenate(p.array)
        return out

    for batch in batches:
        for key, rows in batch.groupby(["lang", "one", "other"], sort=False):
            left = dense(rows.one_none.iloc[0], rows.one_at, rows.one_p)
            right = dense(rows.other_none.iloc[0], rows.other_at, rows.other_p)
            total = np.zeros((left.shape[1], right.shape[1]), np.int64)
            for a in range(left.shape[1]):
                p = left[:, a : a + 1]
                total[a] = ((p - right) ** 2 // (p + right)).sum(axis=0)
            before = sums.get(key)
            sums[key] = (total, len(rows)) if before is None else (before[0] + total, before[1] + len(rows))
        if len(sums) > 200:
            yield from flush()
    yield from flush()


def pair_distances(counts: DataFrame, groups: DataFrame, block: int = BLOCK) -> DataFrame:
    """lang, source, item, value, rank: each source of a language against each other one.

    Sources stand in blocks of `block`. A term meets a pair of blocks when one of them
    has it; terms in neither add the same amount each, by their number. So arrays are
    bounded by the block, and the work by the pairs of blocks in which terms occur.
    """
    blocks = _blocks(counts, groups, block)
    last = groups.groupBy("lang").agg(F.expr(f"max(slot) div {block}").cast("int").alias("last"))
    meeting = salted(blocks, last, ["lang"]).withColumn("with", F.explode(F.expr("sequence(0, last)")))
    meeting = meeting.select(
        "lang", *TERM,
        F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"),
        F.when(F.col("block") <= F.col("with"), F.col("shares")).alias("one_shares"),
        F.when(F.col("block") >= F.col("with"), F.col("shares")).alias("other_shares"),
    ).groupBy("lang", "one", "other", *TERM).agg(
        F.max("one_shares").alias("one_shares"), F.max("other_shares").alias("other_shares")
    )
    none = (
        groups.where("terms > 0").groupBy("lang", F.expr(f"slot div {block}").cast("int").alias("block"))
        .agg(F.expr("transform(array_sort(collect_list(struct(slot, none))), x -> x.none)").alias("none"))
    )
    for side in ("one", "other"):
        own = none.select("lang", F.col("block").alias(side), F.col("none").alias(f"{side}_none"))
        meeting = salted(meeting, own, ["lang", side])
    listed = [
        F.coalesce(F.col(f"{side}_shares.{what}"), F.array().cast(kind)).alias(f"{side}_{what}")
        for side in ("one", "other") for what, kind in (("at", "array<int>"), ("p", "array<long>"))
    ]
    arrow_batches(counts.sparkSession, size=BATCH_BYTES)
    sums = (
        meeting.select("lang", "one", "other", "one_none", "other_none", *listed)
        .mapInPandas(lambda batches: _compare(batches, block), SUMS)
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    )
    turned = sums.where(F.expr(f"a div {block} <> b div {block}")).select(
        "lang", F.col("b").alias("a"), F.col("a").alias("b"), "value", "seen"
    )
    sums = sums.unionByName(turned)
    ours = groups.select("lang", "source", F.col("slot").alias("a"), "terms", F.col("none").alias("p"))
    theirs = groups.select("lang", F.col("source").alias("item"), F.col("slot").alias("b"), F.col("none").alias("q"))
    unseen = (F.col("terms") - F.coalesce("seen", F.lit(0))) * distance(F.col("p"), F.col("q"))
    value = F.coalesce("value", F.lit(0)) + F.coalesce(unseen, F.lit(0))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        ours.join(theirs, "lang").where("a <> b")
        .join(sums, ["lang", "a", "b"], "left")
        .select("lang", "source", "item", value.cast("long").alias("value"))
        .withColumn("rank", F.row_number().over(by_value))
    )


def source_divergence(
    docs: DataFrame,
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP,
    bits: int = BITS,
    block: int = BLOCK,
) -> DataFrame:
    """lang, source, part, item, value, rank: sources compared, and their own terms.

    Null text, lang and source stand as empty ones; empty texts make their group occur
    without terms; rows that repeat count each time; ties go to the smallest item in
    UTF-8 order; other columns are not looked at; an empty table gives no rows. A very
    long text is one row's list of terms in its task. `bits` of a digest decide how
    many terms must be split, and `block` how sources are grouped, never the result.
    Memory: a task holds about GATHERED terms of rows or GATHERED_BYTES of text, a batch
    of LINES lines and one text.
    """
    counts, names = term_counts(docs, least_documents, bits)
    groups = written(group_table(docs, counts), "groups")
    pair = pair_distances(counts, groups, block).withColumn("part", F.lit("pair"))
    term = top_terms(counts, groups, names, top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pair.select(*columns).unionByName(term.select(*columns))
