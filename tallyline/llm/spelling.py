"""Spelling variants: words of a vocabulary that are one edit apart.

The vocabulary is an acceptor, minimised; composed with a transducer that makes one
edit and with the acceptor again it accepts the pairs of words one edit apart. The
composed machine starts in (q, no edit yet, q) and stays there while both words
agree, so its runs fall apart by the state reached after the first symbols: words
with one beginning form a partition, whose acceptor a task builds and composes by
itself. Pairs that differ within the first symbols agree in the last ones; they are
found in the same way on the words read backwards. Each pair is accepted by one run:
the edit stands where the two words first differ.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, written

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, EVERY, TIMES = 7, 2, 31, 10
FIRST = 3  # symbols that tell the initial state of a partition
LARGEST = 50_000  # words of a partition
GATHERED = 300_000  # words a task counts before it hands them on
KEPT = 500_000  # state pairs a partition remembers


# --- words ----------------------------------------------------------------------


def vocabulary(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    every: int = EVERY,
) -> DataFrame:
    """word, n: the runs of letters, some with one letter left out by their checksum."""
    arrow_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = re.compile(f"[{LETTERS}]{{{least_length},}}")
        found = Counter()

        def flush():
            return pd.DataFrame({"word": list(found.keys()), "n": list(found.values())})

        for batch in batches:
            for name, text in zip(batch.name, batch.text):
                start = zlib.crc32(f"{name}:".encode())
                # bytes.lower changes A-Z alone.
                for word, n in Counter(run.findall(text.encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    found[word] += n
                if len(found) >= GATHERED:
                    yield flush()
                    found.clear()
        yield flush()

    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return (
        rows.mapInPandas(count, "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least_count)
    )


# --- one partition --------------------------------------------------------------


class Acceptor:
    """The minimal acceptor of sorted words, and its composition with one edit.

    A state is a number, or, where one word alone goes on from it, the rest of that
    word. Equal states are one state, so what follows an edit is worked out once
    for all beginnings that lead there. `most`: symbols that may follow the edit in
    both words (None: any number).
    """

    def __init__(self, words: list[str], most: int | None = None):
        self.most = sys.maxsize if most is None else most
        self.final: list[bool] = []
        self.edges: list[dict[str, int | str]] = []
        self.least: list[int] = []  # symbols of the shortest word accepted from here
        self._known: dict[tuple, int] = {}
        self._common: dict[tuple, list[str]] = {}
        self._edits: dict[int, list[tuple[str, str]]] = {}
        self.start = self._build(words)

    def _state(self, final: bool, edges: dict[str, int | str]) -> int:
        key = (final, *edges.items())
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.final)
            self.final.append(final)
            self.edges.append(edges)
            self.least.append(0 if final else 1 + min(map(self._shortest, edges.values())))
        return state

    def _shortest(self, state: int | str) -> int:
        return len(state) if isinstance(state, str) else self.least[state]

    def _build(self, words: list[str]) -> int | str:
        if len(words) == 1:
            return words[0]
        path: list[list] = [[False, {}]]  # states not yet complete, with the symbol to each
        symbols: list[str] = []

        def close(depth: int) -> None:
            while len(symbols) > depth:
                state = self._state(*path.pop())
                path[-1][1][symbols.pop()] = state

        before = 0
        for i, word in enumerate(words):
            after = shared(word, words[i + 1]) if i + 1 < len(words) else 0
            close(before)
            deepest = max(before, after)
            for symbol in word[before:deepest]:
                path.append([False, {}])
                symbols.append(symbol)
            if len(word) == deepest:
                path[deepest][0] = True
            else:
                path[deepest][1][word[deepest]] = word[deepest + 1 :]
            before = after
        close(0)
        return self._state(*path[0])

    def _accepts(self, state: int | str, word: str) -> bool:
        at = 0
        while not isinstance(state, str):
            if at == len(word):
                return self.final[state]
            state = self.edges[state].get(word[at])
            if state is None:
                return False
            at += 1
        return state == word[at:]

    def common(self, a: int | str, b: int | str, most: int) -> list[str]:
        """What both states accept, of at most so many symbols."""
        if isinstance(a, str):
            return [a] if len(a) <= most and self._accepts(b, a) else []
        if isinstance(b, str):
            return [b] if len(b) <= most and self._accepts(a, b) else []
        if self.least[a] > most or self.least[b] > most:
            return []
        key = (a, b, most) if a < b else (b, a, most)
        found = self._common.get(key)
        if found is None:
            ours, theirs = self.edges[a], self.edges[b]
            if len(ours) > len(theirs):
                ours, theirs = theirs, ours
            found = [""] if self.final[a] and self.final[b] else []
            for symbol, state in ours.items():
                other = theirs.get(symbol)
                if other is not None:
                    found += [symbol + s for s in self.common(state, other, most - 1)]
            if len(self._common) >= KEPT:
                self._common.clear()
            self._common[key] = found
        return found

    def edits(self, state: int) -> list[tuple[str, str]]:
        """Pairs (u, v) accepted from here that differ at once, one edit apart."""
        if self.least[state] > self.most + 1:
            return []
        found = self._edits.get(state)
        if found is not None:
            return found
        found, rests, inner, edges = [], {}, [], self.edges[state]
        for symbol, to in edges.items():
            if isinstance(to, str):
                if len(to) <= self.most:
                    rests.setdefault(to, []).append(symbol)
            elif self.least[to] <= self.most:
                inner.append((symbol, to))
        # One symbol for another.
        for rest, ends in rests.items():
            found += [(c + rest, d + rest) for c, d in combinations(ends, 2)]
            for symbol, to in inner:
                if self._accepts(to, rest):
                    found += [(symbol + rest, c + rest) for c in ends]
        for (c, one), (d, other) in combinations(inner, 2):
            found += [(c + s, d + s) for s in self.common(one, other, self.most)]
        # One symbol more: v is u with a symbol before it, which does not begin u.
        for rest, ends in rests.items():
            if self._accepts(state, rest):
                found += [(rest, c + rest) for c in ends if rest[:1] != c]
        for symbol, to in inner:
            if self.final[state] and self.final[to]:
                found.append(("", symbol))
            theirs = self.edges[to]
            for d, one in edges.items():
                if d != symbol and d in theirs:
                    for s in self.common(one, theirs[d], self.most - 1):
                        found.append((d + s, symbol + d + s))
        self._edits[state] = found
        return found

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Every pair of accepted words one edit apart, once."""
        stack = [("", self.start)]
        while stack:
            begun, state = stack.pop()
            if isinstance(state, str):
                continue
            for u, v in self.edits(state):
                yield begun + u, begun + v
            stack += [(begun + c, to) for c, to in self.edges[state].items()]


def shared(a: str, b: str) -> int:
    """Symbols that both begin with."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most  # equal up to low, not up to high
    while high - low > 1:
        middle = (low + high) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle
    return low


PAIR = "word string, n long, near string, near_n long"


def _compose(backwards: bool, first: int):
    """Pairs of each partition; rows come sorted by (start, word)."""

    def compose(words: dict[str, int], skip: int) -> pd.DataFrame:
        out = []
        if len(words) > 1:
            listed = list(words)
            begin = listed[0][:skip]
            sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 2 * max(map(len, listed))))
            acceptor = Acceptor([w[skip:] for w in listed], first - 1 if backwards else None)
            for u, v in acceptor.pairs():
                u, v = begin + u, begin + v
                nu, nv = words[u], words[v]
                if backwards:
                    u, v = u[::-1], v[::-1]
                    if u[:first] == v[:first]:
                        continue  # found forwards
                out.append((u, nu, v, nv))
        return pd.DataFrame(out, columns=["word", "n", "near", "near_n"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        start, words = None, {}
        for batch in batches:
            for own, word, n in zip(batch.start, batch.word, batch.n):
                if own != start:
                    if len(words) > 1:
                        yield compose(words, len(start))
                    start, words = own, {}
                words[word] = n
        if len(words) > 1:
            yield compose(words, len(start))

    return run


# --- all partitions -------------------------------------------------------------


def near_words(
    words: DataFrame, first: int = FIRST, largest: int = LARGEST, least_length: int = LEAST_LENGTH
) -> DataFrame:
    """word, n, near, near_n: each pair of words (word, n) one edit apart, once.

    `words` are distinct and have at least `least_length` symbols, at least
    2 * first + 1 of them, so that each pair agrees in its first or last symbols.
    """
    if least_length < 2 * first + 1:
        raise ValueError("words are too short for this many first symbols")
    found = _direction(words, False, first, largest)
    return found.unionByName(_direction(words, True, first, largest))


def _direction(words: DataFrame, backwards: bool, first: int, largest: int) -> DataFrame:
    """Pairs that agree in the first symbols, or, backwards, in the last ones only.

    A beginning with more than `largest` words is no partition: each of its words
    goes to the partition of one symbol more, and pairs that differ at that very
    symbol are found by what is left without it. A beginning is as long as needed,
    the same for all its words, so no pair falls between two partitions.
    """
    read = F.reverse("word") if backwards else F.col("word")
    open_words = words.select(read.alias("word"), "n")
    parts, beside, depth = [], [], first
    while True:
        start = F.substring("word", 1, depth)
        sizes = open_words.groupBy(start.alias("start")).agg(F.count("*").alias("size"))
        # At most one row for each `largest` words.
        hot = written(sizes.where(F.col("size") > largest).select("start"), "hot_states")
        placed = open_words.withColumn("start", start)
        if hot.isEmpty():
            parts.append(placed)
            break
        parts.append(placed.join(hot, "start", "left_anti").select("word", "n", "start"))
        open_words = written(placed.join(hot, "start").select("word", "n"), "hot_words")
        beside.append(_differ_at(open_words, depth))
        open_words = open_words.where(F.length("word") > depth)
        depth += 1
    partitions = parts[0]
    for more in parts[1:]:
        partitions = partitions.unionByName(more)
    arrow_batches(words.sparkSession)
    found = (
        partitions.repartition("start").sortWithinPartitions("start", "word")
        .mapInPandas(_compose(backwards, first), PAIR)
    )
    for more in beside:
        if backwards:
            more = more.withColumns({"word": F.reverse("word"), "near": F.reverse("near")})
            more = more.where(F.substring("word", 1, first) != F.substring("near", 1, first))
        found = found.unionByName(more)
    return found


def _differ_at(words: DataFrame, depth: int) -> DataFrame:
    """Pairs of words that agree in `depth` symbols and differ at the next one."""

    def without() -> Column:
        return F.expr(f"concat(substring(word, 1, {depth}), substring(word, {depth + 2}))")

    cut = words.where(F.length("word") > depth).select(
        without().alias("rest"), "word", "n", F.substring("word", depth + 1, 1).alias("symbol")
    )
    near = cut.select("rest", F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("symbol").alias("other"))
    # Words with one rest differ in one symbol: no more of them than there are letters.
    replaced = cut.join(near, "rest").where("symbol < other")
    longer = (
        words.withColumn("rest", F.col("word")).join(near, "rest")
        .where(F.substring("word", depth + 1, 1) != F.col("other"))
    )
    return replaced.select("word", "n", "near", "near_n").unionByName(
        longer.select("word", "n", "near", "near_n")
    )


# --- forms ----------------------------------------------------------------------


def forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, n, n_near, form_n of every word."""
    ends = pairs.unionByName(
        pairs.select(
            F.col("near").alias("word"), F.col("near_n").alias("n"),
            F.col("word").alias("near"), F.col("n").alias("near_n"),
        )
    )
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    # The largest count first, then the smallest word.
    rank = F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), "near"))
    best = ends.unionByName(alone).groupBy("word").agg(
        F.max("n").alias("n"), F.count("near").alias("n_near"), F.min(rank).alias("best")
    )
    taken = -F.col("best.less") >= F.lit(times) * F.col("n")
    return best.select(
        "word",
        F.when(taken, F.col("best.near")).alias("form"),
        "n", "n_near",
        F.when(taken, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """word, root of every word with a form: the last of its forms.

    Steps are doubled: a form is at least twice as frequent as its word, so there are
    at most 63 steps and six rounds.
    """
    now = written(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = written(
            now.join(onward, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "roots",
        )
        now = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return now


def spelling_variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    every: int = EVERY,
    times: int = TIMES,
    first: int = FIRST,
    largest: int = LARGEST,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents.

    Words are the maximal runs of letters, A-Z lower-cased; a run whose checksum with
    its document's id is divided by `every` loses a letter. A null doc_id stands as an
    empty one, a null text has no words, rows that repeat count each time; ties between
    forms go to the smallest word in code-point order; other columns are not looked
    at; an empty table gives no rows. A letter run of any length is one word.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent as its word")
    words = written(vocabulary(docs, least_length, least_count, every), "words")
    pairs = written(near_words(words, first, largest, least_length), "near_words")
    formed = written(forms(words, pairs, times), "formed")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
