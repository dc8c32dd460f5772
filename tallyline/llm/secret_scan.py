"""Secrets in texts: fixed patterns, and guessable or strong values after credential words.

The patterns find assignments, access keys and long hexadecimal runs. Beyond
them, the value that follows a credential word is cut into dictionary words,
dates, repeats, keyboard walks and brute-force spans so that guessing it costs
least (a dynamic programme over its characters); a value that is dear to guess
is a secret, a cheap one (an ordinary word) is prose.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, texts

# The patterns of the three base kinds and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

KINDS = ("assign", "access", "hex", "guess")

# Words after which a value is looked at, beyond the assignments above.
CONTEXT = re.compile(
    r"(?:(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|auth(?:orization)?"
    r"|bearer|api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret)"
    r"""["']?(?:\x20*[:=]\x20*|\x20+is\x20+)["']?(?:(?:bearer|basic)\x20+["']?)?+"""
    r"""|(?<![A-Za-z0-9_])(?:bearer|basic)\x20+["']?)([!-~]{4,})""",
    re.IGNORECASE | re.ASCII,
)
TRAILING = "\"'`,;:.!?)]}>"

# log10 of guesses from which a value counts as a secret.
THRESHOLD = 8.0

# Frequent passwords and words, by rank; the cost of one is the log of its rank.
COMMON = (
    "password 123456 qwerty letmein welcome admin login master dragon monkey sunshine "
    "princess football shadow secret iloveyou trustno1 hello freedom whatever test user "
    "guest root default changeme example the and for that with this from have not are was "
    "you your value name none null true false string text token key pass word your_password "
    "xxxx optional required here please enter forgotten new old reset bearer basic"
).split()

# Words of the corpus that follow them: in at least so many documents outside of
# credential context, so many of them at most (a task holds about 10 MB).
LEAST_DOCS, MOST_WORDS = 5, 100_000
ORDINARY = r"(?<![\p{L}\p{N}_])[a-z]{3,24}(?![\p{L}\p{N}_])"

# Rows of a keyboard, walked in either direction.
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")

UNITS = (1, 2, 3, 4)  # lengths of what is repeated

DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d"
    r"|(?:19|20)\d\d"
)


class GuessCost:
    """log10 of the guesses a value needs, by its cheapest segmentation."""

    def __init__(self, words: list[str] = COMMON):
        self.ranks = {w: i + 1 for i, w in enumerate(words)}
        self.longest = max(map(len, self.ranks), default=0)
        rows = [*KEY_ROWS, *(r[::-1] for r in KEY_ROWS)]
        self.steps = {pair for row in rows for pair in zip(row, row[1:])}

    @staticmethod
    def brute(value: str) -> float:
        """Guesses for one character: the size of the alphabets in use."""
        size = 26 * any(c.islower() for c in value) + 26 * any(c.isupper() for c in value)
        size += 10 * any(c.isdigit() for c in value) + 33 * any(not c.isalnum() for c in value)
        return math.log10(max(size, 2))

    def segments(
        self, value: str, enough: float = math.inf
    ) -> tuple[float, list[tuple[str, int, int]]]:
        """The least cost and its segments (kind, start, end); (enough, []) when it is no less.

        Places that cost `enough` to reach are not followed, so a long value ends
        soon. In a run (a walk or repeats) a start is passed over when an earlier
        one reaches every end of the run for less.
        """
        lower, n, each = value.lower(), len(value), self.brute(value)
        best: dict[int, tuple[float, int, str]] = {0: (0.0, 0, "")}
        far, walk, walk_lead = 0, 0, (0, math.inf)
        repeat, lead = dict.fromkeys(UNITS, 0), {}

        def offer(kind: str, start: int, end: int, cost: float) -> bool:
            nonlocal far
            if cost >= enough:
                return False
            if end not in best or cost < best[end][0]:
                best[end], far = (cost, start, kind), max(far, end)
            return True

        for start in range(n):
            if start > far:
                break
            if start not in best:
                continue
            here = best[start][0]
            offer("brute", start, start + 1, here + each)
            base = here + 0.3  # where segments meet costs a factor of two
            for end in range(start + 3, min(n, start + self.longest) + 1):
                rank = self.ranks.get(lower[start:end])
                if rank:
                    capital = 2 if lower[start:end] != value[start:end] else 1
                    offer("word", start, end, base + math.log10(rank * 10 * capital))
            date = DATE.match(value, start)
            if date:
                guesses = 365.0 * 120 if date.end() - start > 4 else 120.0
                offer("date", start, date.end(), base + math.log10(guesses))
            if start >= walk:
                walk, walk_lead = start + 1, (0, math.inf)
                while walk < n and (lower[walk - 1], lower[walk]) in self.steps:
                    walk += 1
            if here < walk_lead[1] + math.log10((start - walk_lead[0] + 3) / 3):
                walk_lead = (start, here)
                for end in range(start + 3, walk + 1):
                    if not offer("walk", start, end, base + math.log10(40.0 * (end - start))):
                        break
            for unit in UNITS:
                if start > repeat[unit] - unit:
                    end = start
                    while end + unit < n and value[end] == value[end + unit]:
                        end += 1
                    repeat[unit] = end + unit
                    for place in range(unit):
                        lead[unit, place] = (0, math.inf)
                at, cost = lead[unit, start % unit]
                if here < cost + math.log10((start - at) / unit / 2 + 1):
                    lead[unit, start % unit] = (start, here)
                    for times in range(2, (repeat[unit] - start) // unit + 1):
                        guesses = math.log10(times) + unit * math.log10(40.0)
                        if not offer("repeat", start, start + unit * times, base + guesses):
                            break
        if n not in best:
            return enough, []
        out, end = [], n
        while end:
            _, start, kind = best[end]
            out.append((kind, start, end))
            end = start
        return best[n][0], out[::-1]

    def __call__(self, value: str, enough: float = math.inf) -> float:
        return self.segments(value, enough)[0]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the three base kinds, in code points."""
    out = [
        (m.start(), m.end(), 0)
        for m in ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= ASSIGN_LEAST
    ]
    out += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    out += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(out)


def guessed_spans(
    text: str, cost: GuessCost, threshold: float = THRESHOLD
) -> list[tuple[int, int, int]]:
    """Values in credential context that are dear to guess."""
    out, at = [], 0
    while m := CONTEXT.search(text, at):
        value, at = m[1].rstrip(TRAILING), m.start(1)
        if len(value) >= 4 and cost(value, threshold) >= threshold:
            out.append((m.start(1), m.start(1) + len(value), 3))
            at = m.end(1)
    return out


def ordinary_words(docs: DataFrame, least: int = LEAST_DOCS, most: int = MOST_WORDS) -> list[str]:
    """Words in at least `least` documents, the most frequent first, `most` at most.

    What stands after a credential word does not count: a leaked password is not
    a word, however many copies it has.
    """
    bare = F.regexp_replace("text", f"(?i){CONTEXT.pattern}", " ")
    found = F.array_distinct(F.regexp_extract_all(F.lower(bare), F.lit(ORDINARY), F.lit(0)))
    rows = (
        texts(docs).select(F.explode(found).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least)
        .orderBy(F.desc("n"), "word")
        .limit(most)
        .collect()
    )
    return [r.word for r in rows]


def written_out(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in spans)


SCHEMA = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, "
    "base_sha256 string, spans string"
)


def find_secrets(
    docs: DataFrame, words: list[str] = COMMON, threshold: float = THRESHOLD
) -> DataFrame:
    """Counts and spans of secrets for every row of `docs`.

    Spans read kind:start:end in code points, by start, then kind (assign,
    access, hex, guess). A span of kind guess covers the value alone. A null or
    empty text has none; a null doc_id stays null; repeated rows return each
    time; other columns are not looked at; an empty table gives none. Ordinary
    words are those of `words`, then those of `docs` themselves.
    """
    known = set(words)
    ranks = [*words, *(w for w in ordinary_words(docs) if w not in known)]
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cost = GuessCost(shared.value)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.doc_id, batch.text):
                base = base_spans(text)
                more = guessed_spans(text, cost, threshold)
                kinds = [k for _, _, k in base]
                rows.append(
                    (
                        doc_id, kinds.count(0), kinds.count(1), kinds.count(2), len(more),
                        hashlib.sha256(written_out(base).encode()).hexdigest(),
                        written_out(sorted(base + more)) if more else written_out(base),
                    )
                )
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return named(texts(docs).mapInPandas(scan, SCHEMA))
