"""Registered tables and their partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import NESTED, partition_columns

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def register_tables(
    spark: SparkSession, base: str, database: str, tables: list[str] | None = None
) -> list[str]:
    """Create the database and one external Snappy Parquet table per nested entity.

    Tables start without partitions; see `repair`. Data stays when a table is dropped.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{base}/_database'")
    names = []
    for table in tables or list(NESTED):
        parts = partition_columns(table)
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in NESTED[table].fields
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) USING parquet "
            f"OPTIONS (compression 'snappy') PARTITIONED BY ({', '.join(parts)}) "
            f"LOCATION '{base}/{table}'"
        )
        names.append(f"{database}.{table}")
    return names


def register_stored(
    spark: SparkSession, path: str, name: str, schema: StructType, parts: list[str]
) -> str:
    """Create a table over a partitioned folder and load the partitions found there."""
    database = name.split(".")[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{path}/_database'")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({', '.join(parts)}) LOCATION '{path}'"
    )
    repair(spark, name)
    return name


def repair(spark: SparkSession, table: str) -> None:
    """Load partition directories the catalog does not know yet."""
    spark.sql(f"MSCK REPAIR TABLE {table}")


def add_partition(spark: SparkSession, table: str, **values: str) -> None:
    """Load one partition directory."""
    spec = ", ".join(f"{k} = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({spec})")


def show_partitions(spark: SparkSession, table: str) -> DataFrame:
    """Partition names as the catalog lists them."""
    return spark.sql(f"SHOW PARTITIONS {table}")


def _unescaped(value: Column) -> Column:
    # A plus sign is not escaped in directory names, but would decode to a space.
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


def partitions_metadata(spark: SparkSession, table: str) -> DataFrame:
    """One row per partition with a column per partition column; no file is opened.

    Directory names escape some characters as %XX; values come back as they were, and
    the name that stands for a missing value as null.
    """
    listed = show_partitions(spark, table)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    pairs = F.split("partition", "/")
    values = [F.substring(pairs[i], len(name) + 2, 1 << 30) for i, name in enumerate(parts)]
    return listed.select(
        *[
            F.when(value != NULL_PARTITION, _unescaped(value)).alias(name)
            for name, value in zip(parts, values)
        ]
    ).orderBy(*parts)


def latest_partition(spark: SparkSession, table: str, by: str = "region") -> DataFrame:
    """Newest dt per region (or environment), from the catalog alone; null where all are."""
    return partitions_metadata(spark, table).groupBy(by).agg(F.max("dt").alias("latest_dt"))


def select_partition(table: DataFrame, **values: str) -> DataFrame:
    """Rows of the given partition values; other directories are not listed."""
    condition = reduce(lambda a, b: a & b, [F.col(k) == v for k, v in values.items()])
    return table.where(condition)


def explain(spark: SparkSession, query: str) -> DataFrame:
    """The formatted plan of a query, as text."""
    return spark.sql(f"EXPLAIN FORMATTED {query}")


def scan_ledger(scans: dict[str, DataFrame], parts: list[str]) -> DataFrame:
    """scan, partitions, files, bytes, rows: what each scan of a stored table reads.

    Spark's hidden `_metadata` column says which file a row comes from, so files that
    partition pruning leaves out are not in it. Rows are counted by file before
    anything is put together.
    """
    ledger = None
    for name, df in scans.items():
        files = df.groupBy(
            *parts, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size")
        ).agg(F.count("*").alias("_rows"))
        one = files.agg(
            F.count_distinct(F.struct(*parts)).alias("partitions"),
            F.count("_path").alias("files"),
            F.coalesce(F.sum("_size"), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        ).select(F.lit(name).alias("scan"), "partitions", "files", "bytes", "rows")
        ledger = one if ledger is None else ledger.unionByName(one)
    return ledger


def partition_ledger(scans: dict[str, DataFrame], parts: list[str]) -> DataFrame:
    """scan, partition columns, files, rows: the same, partition by partition."""
    ledger = None
    for name, df in scans.items():
        files = df.groupBy(*parts, F.col("_metadata.file_path").alias("_path")).agg(
            F.count("*").alias("_rows")
        )
        one = files.groupBy(*parts).agg(F.count("_path").alias("files"), F.sum("_rows").alias("rows"))
        one = one.select(F.lit(name).alias("scan"), *parts, "files", "rows")
        ledger = one if ledger is None else ledger.unionByName(one)
    return ledger
