import random

import pytest
from conftest import bag, plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.operators import skew
from tallyline.operators.skew import attach, fits_broadcast, hot_keys, number_rows, skew_join

FORCED = {"share": 0.05, "min_rows": 3}


def left_rows(spark, rows):
    return spark.createDataFrame(rows, "k string, a int").repartition(4)


def right_rows(spark, rows):
    return spark.createDataFrame(rows, "k string, b int").repartition(4)


CASES = {
    "hot left": ([("x", i) for i in range(60)] + [("y", 1), ("z", 2)], [("x", 1), ("y", 2)]),
    "hot right": ([("x", 1), ("y", 1), ("w", 1)], [("x", i) for i in range(60)] + [("y", 5)]),
    "both hot": (
        [("x", i) for i in range(40)] + [("y", 1), ("q", 7)],
        [("x", i) for i in range(40)] + [("z", 3)],
    ),
    "different keys hot": (
        [("x", i) for i in range(40)] + [("y", i) for i in range(3)],
        [("y", i) for i in range(40)] + [("x", 1)],
    ),
    "copies": ([("x", 1)] * 60 + [("y", 1)] * 2, [("x", 9)] * 5 + [("y", 9)] * 30),
    "null keys": (
        [(None, i) for i in range(60)] + [("x", 1)],
        [(None, 1)] * 40 + [("x", i) for i in range(30)],
    ),
    "hot key without match": ([("x", i) for i in range(60)], [("y", i) for i in range(60)]),
    "no rows on the right": ([("x", i) for i in range(60)], []),
    "no rows on the left": ([], [("x", i) for i in range(60)]),
}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("case", CASES)
def test_skew_join_equals_plain_join(spark, case, how):
    left, right = left_rows(spark, CASES[case][0]), right_rows(spark, CASES[case][1])
    got = skew_join(left, right, "k", how, **FORCED)
    assert bag(got) == bag(left.join(right, "k", how))


keys = st.sampled_from(["hot", "hot", "hot", "warm", "a", "b", None])
rows = st.lists(st.tuples(keys, st.integers(0, 3)), max_size=60)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=rows, right=rows, how=st.sampled_from(["inner", "left"]))
def test_skew_join_on_random_rows(spark, left, right, how):
    left, right = left_rows(spark, left), right_rows(spark, right)
    assert bag(skew_join(left, right, "k", how, **FORCED)) == bag(left.join(right, "k", how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_on_several_keys(spark, how):
    rng = random.Random(3)

    def sample(n):
        return [
            (rng.choice(["hot", "hot", "hot", "u", None]), rng.choice(["d1", "d2", None]), i)
            for i in range(n)
        ]

    left = spark.createDataFrame(sample(80), "k string, d string, a int").repartition(4)
    right = spark.createDataFrame(sample(50), "k string, d string, b int").repartition(4)
    got = skew_join(left, right, ["k", "d"], how, **FORCED)
    assert bag(got) == bag(left.join(right, ["k", "d"], how))


def test_hot_rows_are_spread_over_tasks(spark):
    """A key with nearly all rows must not end in one task."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(8000).select(
            F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("k"),
            F.lit(1).alias("a"),
        )
        right = spark.createDataFrame([("hot", 1)], "k string, b int")

        def largest(df):
            return (
                df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"))
                .agg(F.max("n")).first()[0]
            )

        plain = largest(left.join(right, "k", "left"))
        spread = largest(skew_join(left, right, "k", "left", min_rows=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plain >= 7200
    assert spread < plain / 2


def test_no_hot_key_leaves_the_plain_join(spark):
    left = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    joined = skew_join(left, left.withColumn("b", F.lit(1)), "k", "left", min_rows=10)
    assert "Union" not in plan_of(joined)


def test_hot_keys(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 400, "x").when(F.col("id") < 700, F.lit(None))
        .otherwise(F.col("id").cast("string")).alias("k")
    )
    found = hot_keys(df, "k", share=0.1, min_rows=10)
    assert found.values == ["x"] and found.null_is_hot
    assert hot_keys(df, "k").values == []


def test_merged_hot_keys_multiply():
    a = skew.HotKeys({"x": 4, "y": 2}, True)
    merged = a.joined_with(skew.HotKeys({"x": 3, "z": 5}))
    assert merged.slices == {"x": 12, "y": 2, "z": 5} and merged.null_is_hot


@pytest.mark.parametrize("how", ["inner", "left"])
def test_attach_both_ways(spark, how):
    fact = left_rows(spark, CASES["null keys"][0] + [("lost", 1)])
    dim = right_rows(spark, [("x", 1), ("y", 2)])
    want = bag(fact.join(dim, "k", how))
    small, large = attach(fact, dim, "k", how), attach(fact, dim, "k", how, max_bytes=1)
    assert "BroadcastHashJoin" in plan_of(small)
    assert bag(small) == bag(large) == want


def test_fits_broadcast_measures_text_and_nesting(spark):
    df = spark.range(100).select(F.array(F.lit("x" * 50), F.lit("y")).alias("c"))
    assert not fits_broadcast(df, 5_000)
    assert fits_broadcast(df, 10_000)
    assert fits_broadcast(df.limit(0), 0)


def numbered_by_hand(rows):
    out, seen = [], {}
    for k, t, e in sorted(rows, key=lambda r: (r[0] or "", r[1] if r[1] is not None else -1, r[2])):
        seen[k] = seen.get(k, 0) + 1
        out.append((k, t, e, seen[k]))
    return sorted(out, key=repr)


@pytest.mark.parametrize(
    "rows",
    [
        [("hot", (i * 37) % 101, i) for i in range(200)] + [("cold", 2, 1), ("cold", 1, 2)],
        [("hot", 5, i) for i in range(200)],
        [(None, i % 7, i) for i in range(150)] + [("hot", i % 3, i) for i in range(150)],
        [("hot", None if i % 2 else i, i) for i in range(100)],
        [(f"k{i % 50}", i, i) for i in range(100)],
    ],
    ids=["spread times", "one time", "null key", "null times", "no hot key"],
)
def test_number_rows_equals_row_number(spark, rows):
    df = spark.createDataFrame(rows, "k string, t int, e int").repartition(4)
    got = number_rows(df, "k", ["t", "e"], "n", share=0.2, min_rows=10)
    assert sorted([tuple(r) for r in got.select("k", "t", "e", "n").collect()], key=repr) == (
        numbered_by_hand(rows)
    )


def test_number_rows_cuts_a_hot_key_into_ranges(spark):
    df = spark.range(4000).select(
        F.lit("hot").alias("k"), (F.col("id") * 7919 % 4001).alias("t"), F.col("id").alias("e")
    )
    got = number_rows(df, "k", ["t", "e"], "n", min_rows=50)
    assert "__range" in plan_of(got)
    checks = got.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first()
    assert tuple(checks) == (4000, 1, 4000)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("pair", [("int", "bigint"), ("decimal(18,2)", "bigint"), ("binary", "binary")])
def test_keys_of_other_types_join_as_plain(spark, how, pair):
    """A key that is hot on one side only may not lose its matches."""
    a, b = pair
    as_key = "CAST(CAST(id % 2 AS STRING) AS BINARY)" if a == "binary" else f"CAST(id % 2 AS {a})"
    bs_key = "CAST(CAST(id % 2 AS STRING) AS BINARY)" if b == "binary" else f"CAST(id % 2 AS {b})"
    left = spark.range(200).selectExpr(f"{as_key} AS k", "CAST(id % 3 AS INT) AS d", "id AS x")
    right = spark.range(12).selectExpr(f"{bs_key} AS k", "CAST(id % 3 AS INT) AS d", "id AS y")
    got = skew.skew_join(left, right, ["k", "d"], how, share=0.1, min_rows=5)
    assert bag(got.select("x", "y")) == bag(left.join(right, ["k", "d"], how).select("x", "y"))
