"""An index by key that is merged piece by piece.

Rows lie in buckets by a hash of their key. A merge reads and rewrites the buckets
that new rows fall into, under a new version; other buckets keep their files. A list
of each bucket's version, one small file, is written last: readers go by the newest
list, so a merge that fails before leaves the index as it was.

One merge at a time; older versions stay on disk for readers that still use them.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .latest import latest_per_key

BUCKETS = 64
LISTED = "bucket int, of int, buckets int, fields string, version int"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _listed(spark: SparkSession, base: str) -> list:
    """Rows (bucket, of, buckets, fields) of the newest list; none without an index.

    At most one row for each bucket reaches the driver.
    """
    try:
        lists = spark.read.schema(LISTED).parquet(f"{base}/lists")
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    newest = lists.agg(F.max("version")).first()[0]
    return lists.where(F.col("version") == newest).collect()


def _read(spark: SparkSession, base: str, listed: list) -> DataFrame:
    fields = StructType.fromJson(json.loads(listed[0].fields))
    paths = [f"{base}/rows/version={r.of}/bucket={r.bucket}" for r in listed]
    return spark.read.schema(fields).parquet(*paths)


def version(spark: SparkSession, base: str) -> int:
    """Number of the newest version; 0 without an index."""
    listed = _listed(spark, base)
    return listed[0].version if listed else 0


def read_index(
    spark: SparkSession, base: str, keys: DataFrame | None = None, key: str = "transaction_id"
) -> DataFrame:
    """The newest version of the index; with `keys`, only rows of these keys.

    Keys name the buckets they are in, so other buckets are not opened. Nulls in
    `keys` match nothing.
    """
    listed = _listed(spark, base)
    if not listed:
        raise ValueError(f"no index at {base}")
    if keys is None:
        return _read(spark, base, listed)
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    # At most one row for each bucket.
    asked = wanted.select(bucket_of(key, listed[0].buckets).alias("b")).distinct().collect()
    touched = {r.b for r in asked}
    some = [r for r in listed if r.bucket in touched]
    if not some:
        return _read(spark, base, listed[:1]).where("false")
    return _read(spark, base, some).join(wanted, key, "left_semi")


def merge_increment(
    rows: DataFrame,
    base: str,
    newest: list[str | Column],
    key: str = "transaction_id",
    buckets: int = BUCKETS,
) -> int:
    """Merge rows into the index and return its new version.

    Of each key the row with the highest `newest` stays, as if all increments had
    been merged at once; columns that only some increments have are null elsewhere.
    `buckets` counts for a new index only. Without rows nothing is written. The rows
    of a very frequent key are thinned to one in each task that reads them.
    """
    spark = rows.sparkSession
    listed = _listed(spark, base)
    buckets = listed[0].buckets if listed else buckets
    # Only rows that can win travel further.
    rows = latest_per_key(rows, [key], newest)
    touched = {
        r.b for r in rows.select(bucket_of(key, buckets).alias("b")).distinct().collect()
    }
    if not touched:
        return listed[0].version if listed else 0
    old = [r for r in listed if r.bucket in touched]
    if listed:
        known = _read(spark, base, old) if old else _read(spark, base, listed[:1]).where("false")
        rows = known.unionByName(rows, allowMissingColumns=True)
    number = listed[0].version + 1 if listed else 1
    merged = latest_per_key(rows, [key], newest).withColumn("bucket", bucket_of(key, buckets))
    # A run that failed may have left files of this version, which no list names.
    merged.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(
        f"{base}/rows/version={number}"
    )
    fields = StructType([f for f in merged.schema.fields if f.name != "bucket"])
    now = {r.bucket: r.of for r in listed} | dict.fromkeys(touched, number)
    entries = [(b, of, buckets, fields.json(), number) for b, of in sorted(now.items())]
    spark.createDataFrame(entries, LISTED).coalesce(1).write.mode("append").parquet(f"{base}/lists")
    return number
