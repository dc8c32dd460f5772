"""What the classifiers make of odd labels and odd letters."""

import random
import tracemalloc
from collections import Counter
from functools import partial

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tallyline.llm import language, quality, toxicity
from tallyline.llm.common import among, maybe_in

DOCS = "doc_id long, text string"
MARKS = "doc_id long, toxic int"


# --- language -------------------------------------------------------------------


@pytest.mark.parametrize("text", ["½ ² ①", "12 3٤", "_-_ ​", "́̂", "", None, "Ⅷ ㊿"])
def test_texts_without_letters_have_no_language(spark, text):
    rows = [(i, "der hund und die katze", "de") for i in range(8)]
    rows += [(i, "the dog and the cat", "en") for i in range(8, 16)] + [(99, text, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify_all(docs).collect()}
    letters = any(c.isalpha() for c in text or "")
    assert (got[99] == "und") is (not letters) and got[0] == "de" and got[8] == "en"


def test_letters_are_those_of_the_language_itself():
    rng = random.Random(1)
    pools = ["ab½²cd①", "xy_3 Ⅷé", None]
    for i in range(3000):
        pool = pools[i % 3]
        text = "".join(
            rng.choice(pool) if pool
            else chr(rng.choice([rng.randrange(0xD800), rng.randrange(0xE000, 0x20000)]))
            for _ in range(12)
        )
        runs = "".join(c if c.isalpha() else " " for c in text).split(" ")
        assert language.letter_runs(text) == Counter(r for r in runs if r), repr(text)


def test_the_most_frequent_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGS", 2)
    rows = [(i, "a b c", lang) for i, lang in enumerate(["x"] * 30 + ["y"] * 20 + ["z"] * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.lang for r in language.training_rows(docs).select("lang").distinct().collect()} == {"x", "y"}


# --- toxicity -------------------------------------------------------------------


def labelled(spark, bad, good, seed=1):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(200)]
    rows, marks = [], []
    for i in range(bad + good):
        text = [rng.choice(words) for _ in range(20)]
        if i < bad:
            text += ["vilething"] * (rng.random() < 0.9)
        rows.append((i * 7, " ".join(text)))
        marks.append((i * 7, int(i < bad)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(marks, MARKS)


@pytest.mark.parametrize("classes", [(40, 0), (0, 40), (1, 1), (0, 0)])
def test_labels_that_teach_nothing_call_every_text_clean(spark, classes):
    docs, marks = labelled(spark, *classes)
    docs = docs.unionByName(spark.createDataFrame([(None, None), (5, "")], DOCS))
    got = toxicity.score_all(docs, marks).collect()
    assert len(got) == sum(classes) + 2 and not any(r.predicted for r in got)


def test_scores_do_not_depend_on_the_bound(spark):
    docs, marks = labelled(spark, 60, 900)
    wide, narrow = toxicity.train(docs, marks), toxicity.train(docs, marks, most=200)
    for text in ("", "unknown words only", "word1 word2 word3"):
        a, b = (m.score(toxicity.Places(m.chosen).of(toxicity.words_of(text))) for m in (wide, narrow))
        assert abs(a - b) < 0.08 and a < 0.3
    for model in (wide, narrow):
        assert model.score(toxicity.Places(model.chosen).of({"vilething", "word1"})) > 0.5


def test_clashing_labels_are_toxic(spark):
    marks = spark.createDataFrame([(7, 0), (7, 1), (7, 0), (14, 0)], MARKS)
    assert {tuple(r) for r in toxicity.usable_labels(marks).collect()} == {(7, 1), (14, 0)}


def test_gradient_of_the_fit_vanishes():
    """At the weights found, the loss rises in every direction."""
    rng = np.random.default_rng(1)
    rows = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(80)]
    labels = (rng.random(80) < 0.4).astype(float)
    pairs = [(np.array([0]), np.array([1])), (np.array([2]), np.array([], np.int64))]
    w, bias = toxicity.fit(rows, labels, pairs, 6, ridge=1.0, swap=0.5, rounds=4000)

    def loss(w, bias):
        z = np.array([w[r].sum() for r in rows]) + bias
        swap = sum((w[a].sum() - w[b].sum()) ** 2 for a, b in pairs)
        return (
            np.mean(np.log1p(np.exp(z)) - labels * z) + 1.0 / (2 * 80) * (w @ w) + 0.5 / (2 * 2) * swap
        )

    for i in range(6):
        step = np.zeros(6)
        step[i] = 1e-4
        slope = (loss(w + step, bias) - loss(w - step, bias)) / 2e-4
        assert abs(slope) < 1e-4
    assert abs((loss(w, bias + 1e-4) - loss(w, bias - 1e-4)) / 2e-4) < 1e-4


def test_the_fit_holds_little_besides_packed_sets():
    """The same sums as over whole rows, in memory that does not grow by objects and copies."""
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 400, 6000).astype(np.int32)
    sizes[:3] = 0
    places = rng.integers(0, 8000, int(sizes.sum())).astype(np.uint16)
    sets, none = toxicity.Sets(sizes, places), toxicity.Sets(np.empty(0, np.int32), np.empty(0, np.uint16))
    weights, values = rng.random(8000), rng.random(6000)
    row = np.repeat(np.arange(6000), sizes)
    assert len(sets.pieces) > 3
    assert np.allclose(sets.sums(weights), np.bincount(row, weights[places], 6000))
    assert np.allclose(sets.spread(values, 8000), np.bincount(places, values[row], 8000))
    assert not none.sums(weights).size and not none.spread(np.empty(0), 8000).any()
    tracemalloc.start()
    toxicity.fit(sets, (values > 0.5).astype(float), (none, none), 8000, rounds=3)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6 * places.nbytes  # whole copies take 40 bytes for each feature of a set


def test_documents_reach_the_driver_packed(spark, monkeypatch):
    got = []
    own = toxicity.fit
    monkeypatch.setattr(toxicity, "fit", lambda *a, **k: got.append(a) or own(*a, **k))
    docs, marks = labelled(spark, 60, 300)
    toxicity.train(docs, marks)
    sets, toxic, (left, right), size = got[0]
    assert sets.n == len(toxic) and 0 < toxic.sum() < len(toxic) and left.n == right.n > 0
    assert sets.places.dtype.itemsize <= 2 and sets.places.max() < size


# --- quality --------------------------------------------------------------------


def test_ratios_cut_each_text_once(spark):
    """One cut for both counts, which are right also where the bitmap is wrong of some ids."""
    texts = ["one two", "two, three!", "", None, "one", "odd # one"]
    docs = spark.createDataFrame(
        [(i % 40 if i % 9 else None, texts[i % 6]) for i in range(120)], DOCS
    )
    good = {i for i in range(0, 40, 3)}
    marks = spark.createDataFrame([(i, int(i in good)) for i in range(40)] * 2, "doc_id long, quality int")
    buckets = 1 << 10
    raw, trusted = np.zeros(buckets), np.zeros(buckets)
    for r in docs.select("doc_id", quality.ngram_buckets(F.coalesce("text", F.lit("")), buckets).alias("b")).collect():
        np.add.at(raw, r.b, 1)
        np.add.at(trusted, r.b, r.doc_id in good)
    share = lambda n: np.log((n + 1) / (n.sum() + buckets))
    found = quality.log_ratios(docs, marks, buckets)
    assert np.allclose(found.first().ratios, share(trusted) - share(raw), atol=1e-6)
    assert "zip_with" not in found._jdf.queryExecution().optimizedPlan().toString()
    ids = marks.where("quality > 0").select("doc_id")
    rows = docs.where("doc_id IS NOT NULL")
    for bits in (2, 26):
        assert among(rows, ids, bits).count() + among(rows, ids, bits, but=True).count() == rows.count()


def test_no_row_carries_the_ratios(spark, data_dir):
    """Their 4 MB were copied for each row; now they stand in the score itself."""
    docs, marks = (spark.read.parquet(f"{data_dir}/{name}.parquet") for name in ("documents", "labels"))
    assert "AS _ratios" not in plan_of(quality.judge(docs, marks))


@pytest.mark.parametrize("bits", [1, 3, 26])
def test_trusted_rows_are_told_whatever_the_bitmaps_say(spark, monkeypatch, bits):
    """Only texts in both bitmaps are joined; the counts are those of all rows."""
    for name, told in (("among", among), ("maybe_in", maybe_in)):
        monkeypatch.setattr(quality, name, partial(told, bits=bits))
    docs = spark.createDataFrame([(i if i % 7 else None, f"w{i % 5} x") for i in range(60)] * 2, DOCS)
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(50)], "doc_id long, quality int")
    buckets = 1000
    raw, trusted = np.zeros(buckets), np.zeros(buckets)
    for r in docs.select("doc_id", quality.ngram_buckets(F.col("text"), buckets).alias("b")).collect():
        np.add.at(raw, r.b, 1)
        np.add.at(trusted, r.b, r.doc_id is not None and r.doc_id < 50 and r.doc_id % 4 == 0)
    share = lambda n: np.log((n + 1) / (n.sum() + buckets))
    found = quality.log_ratios(docs, marks, buckets).first().ratios
    assert np.allclose(found, share(trusted) - share(raw), atol=1e-6)


def test_repeated_windows_are_told_by_whole_hashes(spark):
    """Hashes that share their upper bits, and negative ones, are not taken for each other."""
    one, other, least = 5 << 31, (5 << 31) + 1, -(1 << 63)
    rows = [
        (1, [one, 1 << 40, 2 << 40, 3 << 40, other, 4 << 40, 5 << 40, 6 << 40, one], 6),
        (2, [least, least + 1, least + 2], 0),
        (3, [-1, 7, 8, 9, 10, -2, 11, 12, 13, -1, -1], 7),
        (4, [], 0),
        (5, [3] * 70_000, 70_002),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "k int, h array<long>")
    got = {r.k: r.n_repeat_words for r in quality.repeated_words(df, "h", "k").collect()}
    assert got == {k: n for k, _, n in rows}
