"""The jobs from path to path, in the order they run.

    snapshot_signals_job -> (running streams) -> match_job -> final_index_job
    star_index_job -> merge_job

Each writes a Parquet dataset and returns its number of rows, counted while
writing.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.final_index import build_final_index, merge_indexes
from ..operators.matching import match_statements, star_enrich
from ..schemas import ML_SIGNAL
from ..session import size_shuffles
from ..sources.signals import ingest_signals, snapshot, store_signals
from ..sources.sinks import write_table
from ..sources.tables import read_table
from ..sources.topics import read_topic
from ..streaming.index import signal_index_job, transaction_index_job


def _now() -> str:
    return datetime.now(UTC).replace(tzinfo=None).isoformat()


def intake_job(spark: SparkSession, payloads: str, store: str, rejected: str) -> tuple[int, int]:
    """Posted payloads (text files) to the signal store; incomplete records aside."""
    good, bad = ingest_signals(spark.read.text(payloads))
    return store_signals(good, store), write_table(bad, rejected, mode="append")


def snapshot_signals_job(spark: SparkSession, store: str, output: str) -> bool:
    """All stored signals as one table; nothing is written when there are none."""
    return snapshot(read_table(spark, store, ML_SIGNAL), output)


def transaction_stream_job(
    spark: SparkSession, servers: str, output: str, topic: str = "transactions_topic"
) -> StreamingQuery:
    """Transactions topic to the stream index, every five seconds."""
    messages = read_topic(spark, servers, topic)
    return transaction_index_job(messages, output, f"{output}/_checkpoints")


def signal_stream_job(
    spark: SparkSession,
    servers: str,
    transactions: str,
    output: str,
    checkpoint: str,
    topic: str = "fraud_signals_topic",
) -> StreamingQuery:
    """Fraud-signals topic, joined to the transactions table, to the stream index."""
    messages = read_topic(spark, servers, topic)
    return signal_index_job(
        spark, messages, read_table(spark, transactions), output, checkpoint
    )


def match_job(
    spark: SparkSession,
    stream_index: str,
    statements: str,
    output: str,
    run_ts: str | None = None,
    dedupe: bool = False,
) -> int:
    """Stream index and bank statements to the batch index."""
    size_shuffles(spark, stream_index, statements)
    out = match_statements(
        read_table(spark, stream_index), read_table(spark, statements), run_ts or _now(), dedupe
    )
    return write_table(out, output)


def final_index_job(
    spark: SparkSession,
    batch_index: str,
    signals: str,
    stream_index: str,
    output: str,
    run_ts: str | None = None,
    dedupe: bool = False,
) -> int:
    """Batch index, fraud signals and stream index to the final index."""
    size_shuffles(spark, batch_index, signals, stream_index)
    out = build_final_index(
        read_table(spark, batch_index),
        read_table(spark, signals),
        read_table(spark, stream_index),
        run_ts or _now(),
        dedupe,
    )
    return write_table(out, output)


def star_index_job(
    spark: SparkSession,
    transactions: str,
    policies: str,
    merchants: str,
    users: str,
    output: str,
) -> int:
    """Transactions with their policy, merchant and user to the batch index."""
    size_shuffles(spark, transactions, policies, merchants, users)
    tables = [read_table(spark, p) for p in (transactions, policies, merchants, users)]
    return write_table(star_enrich(*tables), output)


def merge_job(spark: SparkSession, stream_index: str, batch_index: str, output: str) -> int:
    """Both indexes to one, the newest row per transaction."""
    size_shuffles(spark, stream_index, batch_index)
    out = merge_indexes(read_table(spark, stream_index), read_table(spark, batch_index))
    return write_table(out, output)
