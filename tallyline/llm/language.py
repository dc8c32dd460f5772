"""Languages of a text as a mixture of languages, word by word.

Each language is a multinomial over letter n-grams. A text's words come from a
mixture of languages whose proportions are found by expectation-maximisation;
languages join the set while the penalised likelihood gains by it.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NO_ID, held_out, mix, named, texts

WORDLIKE = re.compile(r"[^\W\d_]+")
SIZES = (1, 2, 3)  # letters in an n-gram; the word's ends count as letters
BITS = 16  # hash space of n-grams: a table row for each bucket
SMOOTHING = 0.5  # added to every bucket's count
DOCS_EACH = 4_000  # documents a language is learned from, at most
MOST_LANGS = 200
ROUNDS, CLOSE = 20, 1e-3
PENALTY = 6.0  # log-likelihood a language must bring, times log(words)
UNKNOWN = "und"


def letter_runs(text: str) -> Counter:
    """Runs of letters, as str.isalpha has them, and how often each stands in the text.

    The pattern also takes fractions, raised figures and numbers in circles, which
    are neither letters nor decimal digits; a run that holds one is cut there.
    """
    seen = Counter(WORDLIKE.findall(text))
    for word in [w for w in seen if not w.isalpha()]:
        n = seen.pop(word)
        for run in "".join(c if c.isalpha() else " " for c in word).split():
            seen[run] += n
    return seen


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the words, and the word number of each."""
    line = np.frombuffer(("^" + "$^".join(words) + "$").encode("utf-32-le"), np.uint32)
    codes = line.astype(np.uint64)
    word = np.cumsum(line == ord("^")) - 1
    found, owner = [], []
    for n in SIZES:
        size = len(codes) - n + 1
        key = np.full(size, n, np.uint64)
        for k in range(n):
            key += codes[k : k + size] * _ODD[k]
        inside = word[:size] == word[n - 1 :]
        found.append((mix(key[inside]) >> np.uint64(64 - BITS)).astype(np.int64))
        owner.append(word[:size][inside])
    return np.concatenate(found), np.concatenate(owner)


@dataclass
class Model:
    """log P(bucket | language), a row for each bucket and a column for each language."""

    langs: list[str]
    logs: np.ndarray

    def words(self, words: list[str]) -> np.ndarray:
        """Log-likelihoods of words, shared out over their overlapping n-grams."""
        found, owner = buckets(words)
        out = np.empty((len(words), len(self.langs)))
        for i in range(len(self.langs)):
            out[:, i] = np.bincount(owner, weights=self.logs[found, i], minlength=len(words))
        return out / len(SIZES)


def training_rows(docs: DataFrame, each: int = DOCS_EACH) -> DataFrame:
    """Text and language of at most `each` documents of a language, not held out.

    Of more than MOST_LANGS languages those with most documents are learned, of
    equally frequent ones the first by name.
    """
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    rows = rows.where(~held_out()).select("doc_id", "text", "lang")
    known = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    known = known.orderBy(F.desc("_n"), "lang").limit(MOST_LANGS).select("lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (
        rows.select("doc_id", "lang").join(F.broadcast(known), "lang")
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= each)
        .select("doc_id", F.col("lang").alias("_lang"))
        .distinct()
    )
    return (
        # At most `each` ids of MOST_LANGS languages.
        rows.join(F.broadcast(ids), "doc_id")
        .where("lang = _lang")
        .select("text", "lang")
    )


def train(docs: DataFrame, each: int = DOCS_EACH) -> Model:
    """Count letter n-grams by language.

    Bounds: `each` documents of a language and MOST_LANGS languages are learned
    from; a row of 2**BITS counts for each language reaches the driver.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, rows in batch.groupby("lang"):
                seen: Counter = Counter()
                for text in rows.text:
                    seen.update(letter_runs(text.lower()))
                if seen:
                    found, owner = buckets(list(seen))
                    times = np.fromiter(seen.values(), float, len(seen))[owner]
                    n = np.bincount(found, weights=times, minlength=1 << BITS)
                    totals[lang] = totals.get(lang, 0) + n
        for lang, n in totals.items():
            cell = n.nonzero()[0]
            yield pd.DataFrame({"lang": lang, "cell": cell, "n": n[cell].astype(np.int64)})

    counts = (
        training_rows(docs, each)
        .mapInPandas(count, "lang string, cell long, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list("cell").alias("cells"), F.collect_list("n").alias("ns"))
        .orderBy("lang")
        .collect()
    )
    table = np.full((1 << BITS, len(counts)), SMOOTHING)
    for i, r in enumerate(counts):
        table[np.array(r.cells), i] += np.array(r.ns, float)
    return Model([r.lang for r in counts], np.log(table / table.sum(axis=0)))


def proportions(logs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture proportions of the columns of `logs` and the log-likelihood, by EM.

    logs: log-likelihood of each different word (row) under each language.
    """
    top = logs.max(axis=1, keepdims=True)
    like = np.exp(logs - top)
    share = np.full(logs.shape[1], 1.0 / logs.shape[1])
    total = counts.sum()
    for _ in range(ROUNDS):
        mixed = like @ share
        new = share * (like.T @ (counts / mixed)) / total
        moved = np.abs(new - share).max()
        share = new
        if moved < CLOSE:
            break
    return share, float(counts @ (np.log(like @ share) + top[:, 0]))


def languages(
    logs: np.ndarray, counts: np.ndarray, penalty: float = PENALTY
) -> tuple[list[int], np.ndarray]:
    """The set of languages (largest share first) and their shares.

    Sets grow in order of the shares found with all languages, while the
    log-likelihood rises by more than the penalty for one more proportion.
    """
    price = penalty * math.log(counts.sum() + 1)
    alone = counts @ logs
    if logs.shape[1] == 1:
        return [0], np.ones(1)
    share, _ = proportions(logs, counts)
    first = int(alone.argmax())
    order = [first, *(i for i in np.argsort(-share, kind="stable") if i != first)]
    best, shares, gained = [first], np.ones(1), float(alone[first])
    for size in range(2, len(order) + 1):
        tried, likelihood = proportions(logs[:, order[:size]], counts)
        if likelihood - gained <= price:
            break
        best, shares, gained = [int(i) for i in order[:size]], tried, likelihood
    rank = np.argsort(-shares, kind="stable")
    return [best[i] for i in rank], shares[rank]


SCHEMA = (
    "doc_id long, held_out boolean, lang_pred string, score double, "
    "languages array<string>, proportions array<double>"
)


def identify(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """Languages of every row: the largest is lang_pred, its proportion the score.

    A null or empty text, or one without a letter, is `und` with score 0, as is
    every text when nothing could be learned. A null doc_id stays null; repeated
    rows return each time; columns other than doc_id and text are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.logs))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(*shared.value)
        known: dict[str, int] = {}
        table = np.empty((0, len(model.langs)))
        for batch in batches:
            rows = []
            for start in range(0, len(batch), 200):
                part = batch.text.iloc[start : start + 200]
                seen = [letter_runs(t.lower()) if model.langs else {} for t in part]
                if len(known) > 300_000:
                    known, table = {}, table[:0]
                new = list({w for words in seen for w in words if w not in known})
                if new:
                    known.update(zip(new, range(len(known), len(known) + len(new))))
                    table = np.concatenate([table, model.words(new)])
                for words in seen:
                    if not words:
                        rows.append((UNKNOWN, 0.0, [], []))
                        continue
                    logs = table[[known[w] for w in words]]
                    counts = np.fromiter(words.values(), float, len(words))
                    found, shares = languages(logs, counts, penalty)
                    names = [model.langs[i] for i in found]
                    rows.append((names[0], float(min(shares[0], 1.0)), names, shares.tolist()))
            out = pd.DataFrame(rows, columns=["lang_pred", "score", "languages", "proportions"])
            out.insert(0, "held_out", batch.held_out.to_numpy())
            out.insert(0, "doc_id", batch.doc_id.to_numpy())
            yield out

    rows = texts(docs).select(
        "doc_id",
        F.when(F.col("doc_id") != NO_ID, held_out()).otherwise(False).alias("held_out"),
        "text",
    )
    return named(rows.mapInPandas(predict, SCHEMA))


def identify_all(docs: DataFrame, each: int = DOCS_EACH) -> DataFrame:
    """Learn from the documents that are not held out, then identify all."""
    return identify(docs, train(docs, each))
