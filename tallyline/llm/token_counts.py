"""Token counts by looking whole pre-tokens up in the vocabulary.

The tokenizer cuts a text into pre-tokens and merges the bytes of each. Most
pre-tokens of ordinary text are one token already. Which vocabulary strings are
encoded alone as one token is proved once, by encoding each of them; a pre-token
among them counts 1 without being merged, and only the others are merged.

Pre-tokens are cut here by the published pattern. The classes of letters and
numbers differ between Unicode versions, so each character met is tried in the
library's own pre-tokenizer once; a text that holds a character on which the two
disagree, or the name of a special token, is encoded whole by the library.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import NO_ID, arrow_batches, named

VOCABULARY = "byte_bpe_50k"
LIMIT = 1024
CHUNK = 1 << 18  # characters cut into pre-tokens at once
REMEMBERED = 200_000  # merged pre-tokens a task keeps


def _library(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    library.no_truncation()
    library.no_padding()
    return library


@lru_cache(4)
def whole_tokens(vocabulary: str = VOCABULARY) -> frozenset[str]:
    """The vocabulary strings that the library encodes alone as one token, their own.

    Strings that are not valid text by themselves (parts of a character) cannot be
    pre-tokens and are left out; special tokens are found before pre-tokens are cut
    and are left out too. The size is bounded by the vocabulary.
    """
    library = _library(vocabulary)
    special = {t.content for t in library.get_added_tokens_decoder().values()}
    found = set()
    for token, number in library.get_vocab().items():
        text = library.decoder.decode([token])
        if token not in special and text and "�" not in text:
            if library.encode(text, add_special_tokens=False).ids == [number]:
                found.add(text)
    return frozenset(found)


class Counts(dict):
    """Number of tokens of a pre-token: 1 where proved, else merged and remembered."""

    def __init__(self, whole: frozenset[str], library):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.library = whole, library

    def __missing__(self, piece: str) -> int:
        if len(self) > len(self.whole) + REMEMBERED:
            self.clear()
            self.update(dict.fromkeys(self.whole, 1))
        n = len(self.library.encode(piece, add_special_tokens=False))
        if len(piece) <= 64:
            self[piece] = n
        return n


class Counter:
    """Number of tokens of a text."""

    def __init__(self, vocabulary: str, whole: frozenset[str]):
        import public_tokenizers
        import regex

        self.library = _library(vocabulary)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        # A pre-token never goes from a character that is no white space to one that is.
        self.border = regex.compile(r"(?<=\S)(?=\s)")
        self.counts = Counts(whole, self.library)
        self.alike, self.unlike = set(), set()

    def try_characters(self, characters: set[str]) -> None:
        """Note for each character whether pattern and library class it alike.

        Between letters, numbers and signs a character joins the one of its own class.
        """
        for c in characters:
            probe = f"a{c}1{c}!{c}{c} {c}\n{c}a"
            theirs = [at for _, at in self.library.pre_tokenizer.pre_tokenize_str(probe)]
            mine = [m.span() for m in self.pattern.finditer(probe)]
            (self.alike if mine == theirs else self.unlike).add(c)

    def plain(self, text: str) -> bool:
        """Whether the pattern may cut this text."""
        if any(name in text for name in self.special):
            return False
        if text.isascii():
            return True
        characters = set(text)
        self.try_characters(characters - self.alike - self.unlike)
        return self.unlike.isdisjoint(characters)

    def __call__(self, text: str) -> int:
        if not self.plain(text):
            return len(self.library.encode(text, add_special_tokens=False))
        total, start, n = 0, 0, len(text)
        while start < n:
            end = n
            if n - start > CHUNK:
                cut = self.border.search(text, start + CHUNK)
                end = cut.start() if cut else n
            pieces = self.pattern.findall(text, start, end)
            total += sum(map(self.counts.__getitem__, pieces))
            start = end
        return total


SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def count_tokens(
    docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row.

    A null or empty text has no bytes and no tokens; a null doc_id stays null; each
    of repeated rows, and of rows with one doc_id, gets its own line; other columns
    are not looked at; an empty table gives none. A very long text is cut into
    pre-tokens piece by piece, between a word and the white space after it, so it
    is counted whole without a list of all its pre-tokens. No shuffle.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    proved = spark.sparkContext.broadcast(whole_tokens(vocabulary))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter(vocabulary, proved.value)
        for batch in batches:
            yield pd.DataFrame(
                {
                    "doc_id": batch.doc_id,
                    "n_bytes": batch.n_bytes,
                    "n_tokens": [counter(text) for text in batch.text],
                }
            )

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    counted = rows.mapInPandas(count, SCHEMA)
    return named(counted).withColumn("over_limit", F.col("n_tokens") > limit)
