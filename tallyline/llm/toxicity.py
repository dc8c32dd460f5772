"""Toxic texts by a classifier that does not react to which group is named.

Labelled texts become sets of hashed words and letter n-grams. Each labelled
text also yields a pair that differs in an identity term only; the fit penalises
the squared difference of the two scores, so naming a group moves no score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, held_out, named, texts, written

WORDS = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")

# Groups of people that a text may name without being toxic.
IDENTITY = (
    "women men girls boys muslim muslims christian christians jewish jews hindu buddhist "
    "atheist black white asian latino african european american gay lesbian straight bisexual "
    "transgender immigrant immigrants refugee refugees disabled blind deaf old young elderly "
    "frauen männer juden christen flüchtlinge femmes hommes juifs chrétiens musulmans réfugiés "
    "mujeres hombres judíos cristianos musulmanes refugiados"
).split()

SAMPLE = 24_000  # labelled documents the fit sees at most, half of them toxic
FEATURES = 8_192  # hashed features the fit uses
BITS = 22  # hash space the features are chosen from
LEAST = 3  # labelled documents a feature must be in
RIDGE = 1.0  # squared weights in the loss
SWAP = 1.0  # weight of the squared change of score under a swap, per pair
PAIRS = 4  # sentences of a text that may carry a swapped pair
PIECE = 1 << 18  # features of sets that are summed at once


def cells(word: str) -> set[int]:
    """Hashes of the word and of its beginnings of 4 to 6 letters."""
    forms = [f"={word}", *(f"^{word[:n]}" for n in (4, 5, 6) if len(word) >= n)]
    return {xxhash.xxh3_64_intdigest(f) >> (64 - BITS) for f in forms}


def words_of(text: str) -> set[str]:
    return set(WORDS.findall(text.lower()))


def swapped(text: str, terms: list[str], key: int) -> list[tuple[set[str], set[str]]]:
    """Sentences of a text as pairs of word sets that differ in an identity term.

    A sentence with a term has it replaced by another; a text without any lends
    its first sentence, which takes one term and then another.
    """
    if len(terms) < 2:
        return []
    out, listed = [], set(terms)
    sentences = [words_of(s) for s in SENTENCE.findall(text)]
    for i, words in enumerate(s for s in sentences if s & listed):
        if i == PAIRS:
            break
        for term in sorted(words & listed)[:1]:
            other = terms[(terms.index(term) + 1 + (key + i) % (len(terms) - 1)) % len(terms)]
            out.append((words, words - {term} | {other}))
    if not out:
        words = next((s for s in sentences if s), set())
        a = terms[key % len(terms)]
        b = terms[(key + 1 + key // len(terms) % (len(terms) - 1)) % len(terms)]
        out.append((words | {a}, words | {b}))
        out.append((words | {a}, words))
    return out


class Model:
    """Weights of the chosen hashed features."""

    def __init__(self, chosen: np.ndarray, weights: np.ndarray, bias: float):
        self.chosen, self.weights, self.bias = chosen, weights, bias

    def score(self, places: set[int]) -> float:
        total = self.bias + float(self.weights[list(places)].sum()) if places else self.bias
        return 1.0 / (1.0 + float(np.exp(-np.clip(total, -40, 40))))


class Places(dict):
    """Which chosen features a word has, remembered; most words have none."""

    def __init__(self, chosen: np.ndarray, most: int = 400_000):
        super().__init__()
        self.at, self.most = {int(c): i for i, c in enumerate(chosen)}, most

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        found = {self.at[c] for c in cells(word) if c in self.at}
        value = self[word] = tuple(found)
        return value

    def of(self, words: set[str]) -> set[int]:
        return {i for w in words for i in self[w]}


class Sets:
    """Sets of features in as few bytes as they need: sizes, and all places in one array.

    Sums over them go piece by piece, so that what they hold besides is bounded.
    """

    def __init__(self, sizes: np.ndarray, places: np.ndarray):
        self.n, self.widest = len(sizes), int(sizes.max(initial=0))
        self.full = np.flatnonzero(sizes)
        self.sizes, self.places = sizes[self.full], places
        starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes
        cuts = np.searchsorted(starts, np.arange(0, len(places), PIECE))
        ends = np.append(cuts[1:], len(starts))
        # Sets from i to j, their places, and where each of them starts there.
        self.pieces = [
            (slice(i, j), slice(starts[i], starts[j - 1] + self.sizes[j - 1]), starts[i:j] - starts[i])
            for i, j in zip(cuts, ends) if i < j
        ]

    @classmethod
    def of(cls, rows: list[np.ndarray] | Sets) -> Sets:
        if isinstance(rows, Sets):
            return rows
        none = np.empty(0, np.int64)
        return cls(np.array([len(r) for r in rows], np.int64), np.concatenate([none, *rows]))

    def sums(self, weights: np.ndarray) -> np.ndarray:
        """For each set the sum of its features' weights."""
        out = np.zeros(self.n)
        for sets, places, starts in self.pieces:
            out[self.full[sets]] = np.add.reduceat(weights[self.places[places]], starts)
        return out

    def spread(self, values: np.ndarray, size: int) -> np.ndarray:
        """For each feature the sum of the values of the sets that have it."""
        out = np.zeros(size)
        for sets, places, _ in self.pieces:
            each = np.repeat(values[self.full[sets]], self.sizes[sets])
            out += np.bincount(self.places[places], weights=each, minlength=size)
        return out


def fit(
    rows: list[np.ndarray] | Sets, labels: np.ndarray,
    pairs: list[tuple[np.ndarray, np.ndarray]] | tuple[Sets, Sets],
    size: int, ridge: float = RIDGE, swap: float = SWAP, rounds: int = 400,
) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse 0/1 rows with the swap penalty.

    Loss: mean log loss + ridge / (2 n) |w|**2 + swap / (2 pairs) sum (w a - w b)**2,
    by gradient descent with Nesterov's momentum and a step from the curvature bound.
    """
    rows = Sets.of(rows)
    if isinstance(pairs, list):
        pairs = Sets.of([a for a, _ in pairs]), Sets.of([b for _, b in pairs])
    left, right = pairs
    n, m = max(rows.n, 1), max(left.n, 1)
    # Largest eigenvalue of X'X / n, by a few power steps, bounds the step.
    v = np.ones(size)
    top = 1.0
    for _ in range(12):
        u = rows.spread(rows.sums(v), size)
        top = float(np.linalg.norm(u)) or 1.0
        v = u / top
    step = 1.0 / (0.25 * min(1.2 * top, (rows.widest + 1) * n) / n + 0.25 + ridge / n + 4 * swap)
    w, bias = np.zeros(size), float(np.log((labels.sum() + 0.5) / (n - labels.sum() + 0.5)))
    was, was_bias = w.copy(), bias
    for k in range(rounds):
        push = k / (k + 3)
        at, at_bias = w + push * (w - was), bias + push * (bias - was_bias)
        p = 1 / (1 + np.exp(-np.clip(rows.sums(at) + at_bias, -40, 40)))
        miss = (p - labels) / n
        grad = rows.spread(miss, size) + ridge / n * at
        change = left.sums(at) - right.sums(at)
        grad += swap / m * (left.spread(change, size) - right.spread(change, size))
        was, was_bias = w, bias
        w, bias = at - step * grad, at_bias - step * float(miss.sum())
    return w, bias


def usable_labels(marks: DataFrame) -> DataFrame:
    """doc_id and toxic (0 or 1), once each: none held out, of clashing labels the toxic one."""
    rows = marks.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~held_out())
    rows = rows.select(F.col("doc_id").cast("long"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    return rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))


def training_rows(docs: DataFrame, labelled: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Text and label of at most `most` labelled documents.

    Half of them at most are toxic; which ones, the hash of doc_id decides.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = labelled.where("toxic = 1").orderBy(*order).limit(most // 2).unionByName(
        labelled.where("toxic = 0").orderBy(*order).limit(most - most // 2)
    )
    return texts(docs).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic")


NOTHING = Model(np.empty(0, np.int64), np.empty(0), -10.0)  # calls every text clean


def train(
    docs: DataFrame, marks: DataFrame, terms: list[str] = IDENTITY, most: int = SAMPLE,
    size: int = FEATURES,
) -> Model:
    """Choose the features that tell most, then fit them.

    Bounds: `most` documents are looked at, `size` features are collected, and of
    a document only the chosen features reach the driver, two bytes each. The bound
    cuts clean and toxic documents differently; scores are moved back by the two
    shares taken, so they do not depend on it. Labels of one class, or too few for any feature, teach
    nothing: every text is then called clean.
    """
    labelled = usable_labels(marks)
    classes = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(classes) < 2:
        return NOTHING
    taken_toxic = min(1.0, (most // 2) / classes[1])
    taken_clean = min(1.0, (most - most // 2) / classes[0])
    sample = written(training_rows(docs, labelled, most), "labelled")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, bad = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        known: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.text, batch.toxic):
                if len(known) > 400_000:
                    known.clear()
                found: set[int] = set()
                for word in words_of(text):
                    if word not in known:
                        known[word] = list(cells(word))
                    found.update(known[word])
                at = np.fromiter(found, np.int64, len(found))
                n[at] += 1
                if toxic:
                    bad[at] += 1
        cell = n.nonzero()[0]
        yield pd.DataFrame({"cell": cell, "n": n[cell], "bad": bad[cell]})

    def lend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = Places(chosen)
        for batch in batches:
            sets, left, right = [], [], []
            for doc_id, text in zip(batch.doc_id, batch.text):
                sets.append(places.of(words_of(text)))
                for a, b in swapped(text, list(terms), doc_id % 1_000_003):
                    # Equal features cancel out; a pair without a difference tells nothing.
                    x, y = places.of(a), places.of(b)
                    if x != y:
                        left.append(x - y)
                        right.append(y - x)
            row = {"toxic": batch.toxic.to_numpy(np.uint8).tobytes()}
            for name, group in (("sets", sets), ("left", left), ("right", right)):
                all_places = np.fromiter(chain.from_iterable(group), kind)
                row[f"{name}_n"] = np.fromiter(map(len, group), np.int32).tobytes()
                row[name] = all_places.tobytes()
            yield pd.DataFrame([row])

    total = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("bad")).first()
    if not 0 < total.bad < total.n:
        return NOTHING
    counts = (
        sample.mapInPandas(count, "cell long, n long, bad long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .where(F.col("n") >= LEAST)
    )
    # Log-likelihood ratio of the feature against independence from the label.
    rate = float(total.bad) / total.n

    def term(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    good = F.col("n") - F.col("bad")
    gain = term(F.col("bad"), F.col("n") * max(rate, 1e-9)) + term(
        good, F.col("n") * max(1 - rate, 1e-9)
    )
    best = counts.select("cell", gain.alias("gain")).orderBy(F.desc("gain"), "cell").limit(size)
    # Identity terms are always among the features, or nothing could hold them down.
    own, told = set().union(*(cells(t) for t in terms)), {r.cell for r in best.collect()}
    if not told:
        return NOTHING
    chosen = np.array(sorted(own | told), np.int64)
    kind = np.min_scalar_type(len(chosen))
    names = [f"{x}{n}" for x in ("sets", "left", "right") for n in ("_n", "")]
    schema = ", ".join(f"{x} binary" for x in ["toxic", *names])
    packed = sample.mapInPandas(lend, schema).collect()

    def joined(name: str, dtype: type) -> np.ndarray:
        return np.frombuffer(b"".join(r[name] for r in packed), dtype)

    sets, left, right = (
        Sets(joined(f"{x}_n", np.int32), joined(x, kind)) for x in ("sets", "left", "right")
    )
    toxic = joined("toxic", np.uint8).astype(float)
    weights, bias = fit(sets, toxic, (left, right), len(chosen))
    return Model(chosen, weights, bias + float(np.log(taken_clean / taken_toxic)))


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score of every row: near 1 for toxic texts.

    A null or empty text has the score of a text without known words. A null
    doc_id stays null; repeated rows return each time; columns other than doc_id
    and text are not looked at. Without labels of both classes every score is near 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.chosen, model.weights, model.bias))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(*shared.value)
        places = Places(model.chosen)
        for batch in batches:
            scores = [model.score(places.of(words_of(t))) for t in batch.text]
            yield pd.DataFrame(
                {
                    "doc_id": batch.doc_id, "held_out": batch.held_out, "score": scores,
                    "predicted": [int(s >= 0.5) for s in scores],
                }
            )

    rows = texts(docs).select(
        "doc_id",
        F.when(F.col("doc_id") != NO_ID, held_out()).otherwise(False).alias("held_out"),
        "text",
    )
    return rows.mapInPandas(predict, SCHEMA)


def score_all(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Learn from the labelled documents that are not held out, then score all."""
    return named(score(docs, train(docs, marks)))
