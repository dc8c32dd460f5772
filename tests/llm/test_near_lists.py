"""Near duplicates of long sets: signs of several lengths, passages as lists."""

import random

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import jaccard_join


def family(seed: int = 5) -> list[str]:
    """Long texts, edited copies of them near the similarity, and shared passages."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(10**6)}"
    passage = [word() for _ in range(90)]
    out = []
    for n in (130, 500, 530, 700, 1030, 2100):
        base = [word() for _ in range(n)]
        at = r.randrange(n)
        base[at:at] = passage
        out.append(base)
        for edits in (1, n // 60, n // 47, n // 45, n // 43, n // 20):
            copy = list(base)
            for place in r.sample(range(len(copy)), edits):
                copy[place] = word()
            out.append(copy)
        out.append(base[: int(len(base) * 0.82)])
    return [" ".join(words) for words in out]


def sets(texts: list[str]) -> list[set]:
    out = []
    for text in texts:
        words = text.split()
        out.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    return out


def test_components_of_long_texts_equal_brute_force(spark):
    texts = family()
    found = sets(texts)
    least = list(range(len(texts)))
    pairs = [
        (i, j)
        for j in range(len(texts))
        for i in range(j)
        if 100 * len(found[i] & found[j]) >= 80 * len(found[i] | found[j])
    ]
    for _ in texts:
        for i, j in pairs:
            least[i] = least[j] = min(least[i], least[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in jaccard_join.near_duplicates(docs, bits=18).collect()}
    assert len(set(least)) < len(texts) - 10 and len(set(least)) > 6
    assert [got[i].component_id for i in range(len(texts))] == least
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in found]


def test_signs_bound_the_difference_at_every_length(spark):
    r = np.random.default_rng(3)
    rows, differ = [], []
    for n in (40, 500, 512, 515, 1020, 1030, 9000):
        a = r.integers(0, 2**63, n, np.uint64)
        b = np.concatenate([a[: n - n // 9], r.integers(0, 2**63, n // 8, np.uint64)])
        rows.append((len(a), jaccard_join.sign(a).tolist(), len(b), jaccard_join.sign(b).tolist()))
        rows.append((len(b), rows[-1][3], len(a), rows[-1][1]))
        other = r.integers(0, 2**63, n, np.uint64)
        differ.append((n, jaccard_join.sign(a).tolist(), n, jaccard_join.sign(other).tolist()))
    schema = "an int, asign array<long>, bn int, bsign array<long>"

    def near(pairs):
        return [
            x.near
            for x in spark.createDataFrame(pairs, schema)
            .select(
                F.struct(F.col("an").alias("n"), F.col("asign").alias("sign")).alias("a"),
                F.struct(F.col("bn").alias("n"), F.col("bsign").alias("sign")).alias("b"),
            )
            .select(jaccard_join.near_signs("a", "b", 80).alias("near"))
            .collect()
        ]

    assert all(near(rows))
    assert not any(near(differ))


def test_a_passage_is_one_list(spark):
    schema = (
        "doc_id long, mark long, n int, text string, key array<long>, level array<int>, sign array<long>"
    )
    rows = [(i, i, 9, "", [1, 2, 3, 10 + i], [1, 1, 2, 3], [0]) for i in range(3)]
    rows.append((3, 3, 9, "", [7, 10], [1, 2], [0]))
    got = jaccard_join.postings(spark.createDataFrame(rows, schema), 3).collect()
    assert sorted((r.doc_id, r.df, r.upto) for r in got) == [
        (0, 2, [0, 0, 1]), (0, 3, [2, 3, 3]), (1, 3, [2, 3, 3]), (2, 3, [2, 3, 3]),
        (3, 2, [0, 1, 1]),
    ]


def test_texts_in_other_case_are_one_class(spark):
    text = " ".join(f"Word{i}" for i in range(40))
    rows = [(5, text), (3, text.upper()), (4, text), (9, text.lower()), (1, "A b"), (2, "a B"), (7, "É x"), (8, "é x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(docs, bits=16).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 9: 3, 1: 1, 2: 1, 7: 7, 8: 8}
