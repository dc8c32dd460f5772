"""Reading, typing and refreshing Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a Parquet dataset; the file's own schema unless one is given."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the given tables."""
    return read_table(spark, f"{sf_dir}/{name}.parquet")


test_table.__test__ = False


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give loosely typed rows a fixed schema: same names, missing columns null.

    Text that is no valid value of its column becomes null instead of an error.
    """
    columns = []
    for f in schema.fields:
        if f.name not in df.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            columns.append(F.try_to_timestamp(F.col(f.name).cast("string")).alias(f.name))
        else:
            columns.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
    return df.select(*columns)


def head(df: DataFrame, n: int = 50, order_by: list[str] | None = None) -> DataFrame:
    """First `n` rows; give an order for a repeatable answer."""
    if order_by:
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    return df.limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per dataset with its row count."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def refresh(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Forget cached listings of the datasets, read them again and count rows."""
    for path in paths.values():
        spark.catalog.refreshByPath(path)
    return row_counts({name: read_table(spark, path) for name, path in paths.items()})
