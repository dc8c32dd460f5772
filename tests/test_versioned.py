"""An index merged piece by piece, and streams that read it."""

import os
import random

import pytest
from conftest import bag
from pyspark.sql import functions as F

from tallyline.operators import versioned_index as vi
from tallyline.operators.latest import latest_per_key
from tallyline.session import work_path
from tallyline.sources import sinks, topics
from tallyline.streaming import index as stream

NEWEST = ["at"]


def rows_of(spark, seed, n=400):
    """A third of all rows have one key; some have none; times tie."""
    rng = random.Random(seed)
    rows = [
        ("hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(150)}", rng.randrange(30), rng.random())
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "transaction_id string, at int, x double")


def files_of(base):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(f"{base}/rows") for f in names if f.startswith("part-")
    }


def test_increments_equal_one_merge(spark):
    base = work_path(spark, "index")
    pieces = [rows_of(spark, s) for s in range(3)]
    pieces[1] = pieces[1].withColumn("more", F.lit("y"))
    for number, rows in enumerate(pieces, 1):
        assert vi.merge_increment(rows, base, NEWEST, buckets=8) == number == vi.version(spark, base)
    whole = pieces[0]
    for rows in pieces[1:]:
        whole = whole.unionByName(rows, allowMissingColumns=True)
    assert bag(vi.read_index(spark, base)) == bag(latest_per_key(whole, ["transaction_id"], NEWEST))


def test_untouched_buckets_keep_their_files(spark):
    base = work_path(spark, "index")
    vi.merge_increment(rows_of(spark, 1), base, NEWEST, buckets=8)
    before = files_of(base)
    one = spark.createDataFrame([("hot", 99, 1.0)], "transaction_id string, at int, x double")
    bucket = one.select(vi.bucket_of("transaction_id", 8)).first()[0]
    vi.merge_increment(one, base, NEWEST)
    after = files_of(base)
    assert before.items() <= after.items()
    assert {f.split("bucket=")[1].split("/")[0] for f in set(after) - set(before)} == {str(bucket)}
    read = vi.read_index(spark, base).inputFiles()
    assert sum("version=2" in f for f in read) == 1 and len(read) == 8
    assert vi.read_index(spark, base).where("at = 99").count() == 1


def test_a_failed_merge_leaves_the_index(spark):
    base = work_path(spark, "index")
    rows = rows_of(spark, 1)
    vi.merge_increment(rows, base, NEWEST, buckets=4)
    before = bag(vi.read_index(spark, base))
    broken = rows.withColumn("at", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        vi.merge_increment(broken, base, NEWEST)
    # Files of a merge that ended before its list was written.
    rows.limit(5).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{base}/rows/version=2")
    assert vi.version(spark, base) == 1 and bag(vi.read_index(spark, base)) == before
    assert vi.merge_increment(rows, base, NEWEST) == 2 and bag(vi.read_index(spark, base)) == before


def test_empty_increments_and_missing_indexes(spark):
    base = work_path(spark, "index")
    none = rows_of(spark, 1).limit(0)
    assert vi.merge_increment(none, base, NEWEST) == 0
    with pytest.raises(ValueError):
        vi.read_index(spark, base)
    vi.merge_increment(rows_of(spark, 1), base, NEWEST, buckets=4)
    assert vi.merge_increment(none, base, NEWEST) == 1


def test_keys_open_their_buckets_only(spark):
    base = work_path(spark, "index")
    vi.merge_increment(rows_of(spark, 1), base, NEWEST, buckets=16)
    keys = spark.createDataFrame([("hot",), (None,), ("absent",)], "transaction_id string")
    found = vi.read_index(spark, base, keys)
    assert [r.transaction_id for r in found.collect()] == ["hot"]
    assert len([f for f in found.inputFiles() if "/rows/" in f]) <= 2


def test_a_row_added_between_batches_is_seen(spark):
    base, topic, out, ckpt = (work_path(spark, n) for n in ("index", "topic", "out", "ckpt"))
    fields = "transaction_id string, at int, x double"
    looked = []

    def lookup(keys):
        looked.append(keys.count())
        return vi.read_index(keys.sparkSession, base, keys).select("transaction_id", "x")

    def run(ids):
        sinks.publish_json(spark.createDataFrame([(i,) for i in ids], "transaction_id string"), directory=topic)
        rows = topics.parse_messages(topics.read_topic_files(spark, topic), "transaction_id string")
        stream.enrich_batches(rows, lookup, out, ckpt, trigger={"availableNow": True}).awaitTermination()

    vi.merge_increment(spark.createDataFrame([("a", 1, 1.0)], fields), base, NEWEST)
    run(["a", "b", "b"])
    vi.merge_increment(spark.createDataFrame([("b", 1, 2.0)], fields), base, NEWEST)
    run(["b", None])
    got = sorted((int(r.batch), r.transaction_id or "", r.x) for r in spark.read.parquet(out).collect() if r.x)
    assert got == [(0, "a", 1.0), (1, "b", 2.0)]
    assert spark.read.parquet(out).count() == 5 and looked == [2, 1]
