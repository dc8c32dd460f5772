"""Tables derived from the given ones, written once per application.

Jobs hand tables to each other as Parquet in the shared folder: a lost executor
reruns the tasks of one job, and no later job repeats an earlier one's joins.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import staging
from ..operators.compliance import policy_flags
from ..operators.final_index import build_final_index, extend_for_reports
from ..operators.kpis import settlement_schedule
from ..operators.matching import match_statements
from ..schemas import NESTED, partition_columns
from ..session import configure, size_shuffles, work_path
from ..sources import catalog
from ..sources.sinks import write_table
from ..sources.tables import read_table

RUN_TS = "2025-01-19T00:00:00"
AS_OF = "1998-07-01"

_written: dict[tuple, str] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir, name)


def landed(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """Write what `build` returns, once, and read it."""
    key = _key(spark, sf_dir, name)
    if key not in _written:
        path = work_path(spark, name)
        write_table(build(), path)
        _written[key] = path
    return read_table(spark, _written[key])


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Settings for jobs over the tables of a folder."""
    key = (spark.sparkContext.applicationId, "prepared")
    if _written.get(key) != sf_dir:
        configure(spark)
        size_shuffles(spark, *[f"{sf_dir}/{t}.parquet" for t in ("orders", "lineitem", "events")])
        _written[key] = sf_dir


def forget() -> None:
    """Write every table anew when it is next asked for."""
    _written.clear()


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "transactions", lambda: staging.transactions(spark, sf_dir))


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "statements", lambda: staging.statements(spark, sf_dir))


def stream_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with a processing time five seconds after the event."""
    return transactions(spark, sf_dir).withColumn(
        "processed_at", F.col("event_time") + F.expr("INTERVAL 5 SECONDS")
    )


def batch_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(
        spark, sf_dir, "batch_index",
        lambda: match_statements(
            transactions(spark, sf_dir), statements(spark, sf_dir), RUN_TS
        ),
    )


def final_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(
        spark, sf_dir, "final_index",
        lambda: build_final_index(
            batch_index(spark, sf_dir), staging.fraud_signals(spark, sf_dir),
            stream_index(spark, sf_dir), RUN_TS,
        ),
    )


def report_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final index with event time, risk label and payout date."""

    def build() -> DataFrame:
        tx = transactions(spark, sf_dir)
        schedule = settlement_schedule(tx, statements(spark, sf_dir), AS_OF)
        return extend_for_reports(
            final_index(spark, sf_dir), tx, policy_flags(tx, staging.policies(spark)), schedule
        )

    return landed(spark, sf_dir, "report_index", build)


def _nested_base(spark: SparkSession, sf_dir: str) -> str:
    key = _key(spark, sf_dir, "nested")
    if key not in _written:
        _written[key] = work_path(spark, "nested")
    return _written[key]


def nested(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A nested table, stored partitioned by its two partition columns."""
    base = _nested_base(spark, sf_dir)
    key = _key(spark, sf_dir, f"nested/{table}")
    if key not in _written:
        view, finish = staging.NARROW_VIEWS.get(table, (staging.NESTED_VIEWS[table], None))
        write_table(
            view(spark, sf_dir), f"{base}/{table}", partition_columns(table), finish=finish
        )
        _written[key] = f"{base}/{table}"
    return read_table(spark, _written[key], NESTED[table])


def unrepaired(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Name of a freshly created catalog table that knows no partition yet."""
    nested(spark, sf_dir, table)
    database = f"tallyline_{uuid.uuid4().hex[:12]}"
    return catalog.register_tables(spark, _nested_base(spark, sf_dir), database, [table])[0]


def registered(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Name of a nested table in the catalog, its partitions loaded."""
    key = _key(spark, sf_dir, f"catalog/{table}")
    if key not in _written:
        name = unrepaired(spark, sf_dir, table)
        catalog.repair(spark, name)
        _written[key] = name
    return _written[key]


def stored(
    spark: SparkSession, sf_dir: str, name: str, df: DataFrame, parts: list[str]
) -> str:
    """Name of a catalog table with its partitions loaded, written from `df` once."""
    key = _key(spark, sf_dir, f"stored/{name}")
    if key not in _written:
        path = work_path(spark, name)
        write_table(df, path, parts)
        database = f"tallyline_{uuid.uuid4().hex[:12]}"
        _written[key] = catalog.register_stored(spark, path, f"{database}.{name}", df.schema, parts)
    return _written[key]
