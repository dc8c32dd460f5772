"""Spelling variants, token counts and source divergence against brute force."""

import random
import re
import tracemalloc
import zlib
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyline.llm import divergence, spelling, token_counts

FIELDS = "doc_id long, text string, lang string, source string, n long, word string, digest string"


def rows_of(df):
    return Counter(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty, repeated and very long texts, odd characters, clashing names."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(5, 9))) for _ in range(40)]
    rows = [
        (i, " ".join(rng.choice(words) for _ in range(60)), rng.choice(["en", "fr", None]),
         rng.choice(["a", "b", "c", None]), 1, "x", "y")
        for i in range(60)
    ]
    rows += [rows[0], rows[0], (None, rows[1][1], "en", "a", None, None, None)]
    rows += [(70, "", "en", "empty", 0, "", ""), (71, None, None, "none", None, None, None)]
    rows += [(None, None, None, None, None, None, None), (72, " \n\t ", "xx", "alone", 1, "x", "y")]
    rows += [(73, " ".join(rng.choice(words) for _ in range(60_000)), "en", "long", 1, "x", "y")]
    rows += [(74, "q" * 30_000 + " " + "Q" * 30_000 + " " + "q" * 29_999 + "z", "en", "a", 1, "x", "y")]
    rows += [(75, "it's <|endoftext|> we'll 12 ½ ²² 日本語 é ՘x 🙂🙂   a\r\n b  ", "en", "b", 1, "x", "y")]
    return spark.createDataFrame(rows, FIELDS)


# --- spelling -------------------------------------------------------------------


def apart_by_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_spelling(rows):
    words = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = fold(run)
            name = "" if r.doc_id is None else str(r.doc_id)
            h = zlib.crc32(f"{name}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for size, own in by_length.items():
        pairs = list(combinations(own, 2)) + [(a, b) for a in own for b in by_length.get(size + 1, [])]
        for a, b in pairs:
            if apart_by_one(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = Counter()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[form[w], words.get(form[w]), words[w], len(near[w]), root, w] += 1
    return out


def test_acceptor_against_all_pairs():
    rng = random.Random(1)
    for trial in range(500):
        letters = "ab" if trial % 2 else "abcd"
        words = {"".join(rng.choice(letters) for _ in range(rng.randint(0, 6))) for _ in range(20)}
        got = [tuple(sorted(p)) for p in spelling.Acceptor(sorted(words)).pairs()]
        assert len(got) == len(set(got))
        assert set(got) == {p for p in combinations(sorted(words), 2) if apart_by_one(*p)}


def test_equal_states_are_one():
    acceptor = spelling.Acceptor(sorted(a + b for a in "abcdef" for b in ("xab", "xac", "yab", "yac")))
    assert len(acceptor.final) == 4


@pytest.mark.parametrize("largest", [50_000, 3])
def test_spelling_against_brute_force(spark, awkward, largest):
    got = spelling.spelling_variants(awkward, largest=largest)
    want = brute_spelling(awkward.collect())
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(got) == want and any(k[3] for k in want)


def test_roots_follow_chains_of_forms(spark):
    words = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "zzzzzzzz": 5}
    rows = [(w, n) for w, n in words.items()]
    df = spark.createDataFrame(rows, "word string, n long")
    formed = spelling.forms(df, spelling.near_words(df)).cache()
    root = {r.word: r.root for r in spelling.roots(formed).collect()}
    assert root == {w: "abcdefghij" for w in ("abcdefg", "abcdefgh", "abcdefghi")}


def test_words_too_short_for_the_first_symbols_are_refused(spark):
    df = spark.createDataFrame([], "word string, n long")
    with pytest.raises(ValueError):
        spelling.near_words(df, first=4)


# --- tokens ---------------------------------------------------------------------


def test_token_counts_equal_the_library(spark, awkward):
    library = token_counts._library(token_counts.VOCABULARY)
    got = rows_of(token_counts.count_tokens(awkward))
    want = Counter()
    for r in awkward.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False))
        want[r.doc_id, len((r.text or "").encode()), n, n > 1024] += 1
    assert got == want


def test_counter_on_random_characters():
    rng = random.Random(7)
    whole = token_counts.whole_tokens()
    counter = token_counts.Counter(token_counts.VOCABULARY, whole)
    library = token_counts._library(token_counts.VOCABULARY)
    pools = ["ab '\n\t ", "'stremld aZ", "  　\r\n1a²½", "日本é́🙂 ‍"]
    for i in range(3000):
        pool = pools[i % 4]
        text = "".join(
            rng.choice(pool) if rng.random() < 0.9 else chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]))
            for _ in range(rng.randint(0, 30))
        )
        assert counter(text) == len(library.encode(text, add_special_tokens=False)), repr(text)


def test_long_text_is_cut_without_changing_its_count(monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK", 5)
    counter = token_counts.Counter(token_counts.VOCABULARY, token_counts.whole_tokens())
    library = token_counts._library(token_counts.VOCABULARY)
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice("abc  \n'1!") for _ in range(60))
        assert counter(text) == len(library.encode(text, add_special_tokens=False)), repr(text)


def test_proof_holds_only_own_single_tokens():
    library = token_counts._library(token_counts.VOCABULARY)
    whole = token_counts.whole_tokens()
    assert " the" in whole and "<|endoftext|>" not in whole and len(whole) < library.get_vocab_size()
    for text in random.Random(1).sample(sorted(whole), 300):
        assert len(library.encode(text, add_special_tokens=False)) == 1


# --- divergence -----------------------------------------------------------------


def brute_divergence(rows, least, top):
    groups, frequency = {}, Counter()
    for r in rows:
        key = (r.lang or "", r.source or "")
        terms = [fold(t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", r.text or "")]
        groups.setdefault(key, Counter()).update(terms)
        frequency.update((key[0], t) for t in set(terms))
    kept = {}
    for (lang, term), n in frequency.items():
        if n >= least:
            kept.setdefault(lang, []).append(term)

    def shares(counts, terms):
        below = sum(counts[t] for t in terms) + 2 * len(terms)
        return {t: 1 + 10**9 * (counts[t] + 2) // below for t in terms}

    def far(p, q):
        return (p - q) * (p - q) // (p + q)

    own = {k: shares(c, kept.get(k[0], [])) for k, c in groups.items()}
    out = Counter()
    for lang in {k[0] for k in groups}:
        terms = kept.get(lang, [])
        together = sum((groups[k] for k in groups if k[0] == lang), Counter())
        whole = shares(together, terms)
        for k in (k for k in groups if k[0] == lang):
            pairs = [
                (sum(far(own[k][t], own[o][t]) for t in terms), o[1])
                for o in groups if o[0] == lang and o != k
            ]
            best = [
                (far(own[k][t], whole[t]), t)
                for t in terms if groups[k][t] and own[k][t] > whole[t]
            ]
            for part, found, most in (("pair", pairs, None), ("term", best, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (value, item) in enumerate(found[:most], 1):
                    out[item, lang, part, rank, k[1], value] += 1
    return out


@pytest.mark.parametrize("bits", [64, 4, 1])
def test_divergence_against_brute_force(spark, awkward, bits):
    got = divergence.source_divergence(awkward, least_documents=5, bits=bits)
    assert rows_of(got) == brute_divergence(awkward.collect(), 5, 10)


def test_divergence_over_blocks_of_sources(spark):
    rng = random.Random(4)
    rows = [
        (i, " ".join(rng.choice("abcdefghij") + str(i % 3) for _ in range(8)), "en", f"s{rng.randint(0, 10)}")
        for i in range(80)
    ] + [(99, "", "en", "none"), (100, "a b", "de", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = divergence.source_divergence(docs, least_documents=3, block=3)
    assert rows_of(got) == brute_divergence(docs.collect(), 3, 10)


@pytest.mark.parametrize(
    "limit, rows",
    [
        ("GATHERED", [("en", f"s{i % 7}", f"a b{i % 50} c{i}") for i in range(2000)]),
        ("GATHERED", [("en", f"s{i}", "a") for i in range(2000)]),  # few terms, many groups
        ("GATHERED_BYTES", [("en", "s", f"a {'z' * 500}{i % 9}") for i in range(2000)]),
    ],
)
def test_divergence_task_gathers_and_hands_on_bounded_parts(monkeypatch, limit, rows):
    monkeypatch.setattr(divergence, limit, 1000)
    monkeypatch.setattr(divergence, "LINES", 40)
    read, held, n = 0, [], Counter()

    def batches():
        nonlocal read
        for i in range(0, len(rows), 10):
            read += 10
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*rows[i : i + 10])], names=["l", "s", "t"])

    before = 0
    for batch in divergence._gather(batches(), 64, True):
        assert batch.num_rows <= 40
        held.append(read - before)
        before = read
        for r in batch.to_pylist():
            n[r["lang"], r["source"], r["term"]] += r["n"]
    assert max(held) <= 350  # rows between two batches
    assert n == Counter((lang, source, t) for lang, source, text in rows for t in re.findall("[a-z]+", text))


def test_divergence_task_memory_for_each_term_of_a_row():
    rng = random.Random(5)
    words = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnopqrst" for c in "uvwxyz"]
    rows = [("en", f"s{i % 20}", " ".join(rng.sample(words, 300))) for i in range(1500)]
    tracemalloc.start()
    try:
        held = divergence.Gathered()
        for row in rows:
            held.add(*row)
        lines = 0
        for batch in held.batches(64, False):
            lines += batch.num_rows
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert lines == 20 * len(words)
    assert peak < 30 * 300 * len(rows)


def test_share_is_exact_for_large_counts(spark):
    rows = [(0, 1, 1), (1, 1, 1), (10**14, 3 * 10**14 + 1, 5), (7, 8 * 10**15, 10**6)]
    df = spark.createDataFrame(rows, "n long, total long, terms long")
    for r in df.withColumn("p", divergence.share(F.col("n"), F.col("total"), F.col("terms"))).collect():
        assert r.p == 1 + 10**9 * (r.n + 2) // (r.total + 2 * r.terms)


@pytest.mark.parametrize(
    "run", [spelling.spelling_variants, token_counts.count_tokens, divergence.source_divergence]
)
def test_empty_table(awkward, run):
    assert run(awkward.limit(0)).collect() == []
