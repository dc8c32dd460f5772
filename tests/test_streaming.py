"""Streams replayed from files standing in for topics."""

import json

import pytest
from conftest import bag
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.sources import topics
from tallyline.streaming import index, stateful


def publish(folder, name, *records):
    folder.mkdir(exist_ok=True)
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    (folder / name).write_text("\n".join(lines) + "\n")


def tx(i, at="2025-01-01 00:00:00", **more):
    return {"transaction_id": f"t{i}", "amount": 10.25, "status": "APPROVED", "event_time": at,
            **more}


def test_index_resumes_from_its_checkpoint(spark, tmp_path):
    topic, out, ckpt = tmp_path / "topic", f"{tmp_path}/out", f"{tmp_path}/ckpt"
    publish(topic, "1.txt", tx(1), tx(2), "{malformed")
    built = index.build_stream_index(topics.read_topic_files(spark, str(topic)))
    rows = index.drain(built, out, ckpt).collect()
    assert sorted(str(r.transaction_id) for r in rows) == ["None", "t1", "t2"]
    assert all(r.processed_at is not None for r in rows)
    assert index.drain(built, out, ckpt).count() == 3
    publish(topic, "2.txt", tx(3), tx(1))
    again = index.drain(built, out, ckpt)
    assert again.count() == 5
    assert again.where("transaction_id = 't1'").count() == 2


def test_running_job_at_an_interval(spark, tmp_path):
    topic, out = tmp_path / "topic", f"{tmp_path}/out"
    publish(topic, "1.txt", tx(1))
    messages = topics.read_topic_files(spark, str(topic))
    job = index.transaction_index_job(messages, out, f"{tmp_path}/ckpt", "1 second")
    try:
        job.processAllAvailable()
        publish(topic, "2.txt", tx(2))
        job.processAllAvailable()
    finally:
        job.stop()
    assert spark.read.parquet(out).count() == 2


def test_signals_join_static_transactions(spark, tmp_path):
    topic = tmp_path / "topic"
    publish(
        topic, "1.txt",
        {"fraud_id": "f1", "transaction_id": "t1", "fraud_score": 91.5},
        {"fraud_id": "f2", "transaction_id": "unknown", "fraud_score": 1},
    )
    static = spark.createDataFrame([("t1", "u1")], "transaction_id string, user_id string")
    joined = index.enrich_stream(topics.read_topic_files(spark, str(topic)), static)
    assert joined.isStreaming and "processed_at" not in joined.columns
    rows = index.drain(joined, f"{tmp_path}/out", f"{tmp_path}/ckpt").collect()
    assert {r.fraud_id: r.user_id for r in rows} == {"f1": "u1", "f2": None}
    job = index.signal_index_job(
        spark, topics.read_topic_files(spark, str(topic)), static, f"{tmp_path}/o2",
        f"{tmp_path}/c2",
    )
    job.processAllAvailable()
    job.stop()
    assert spark.read.parquet(f"{tmp_path}/o2").count() == 2


def timed(spark, topic, per_batch=None):
    messages = topics.read_topic_files(spark, str(topic), per_batch)
    parsed = topics.parse_messages(messages, schemas.STREAM_TRANSACTION)
    return parsed.withColumn("event_time", F.try_to_timestamp("event_time"))


@pytest.mark.parametrize("salts", [1, 4])
def test_dedupe_within_the_watermark(spark, tmp_path, salts):
    topic = tmp_path / "topic"
    publish(topic, "1.txt", tx(1), tx(1), tx(2, "2025-01-01 05:00:00"))
    stream = stateful.dedupe_stream(timed(spark, topic), salts=salts)
    out, ckpt = f"{tmp_path}/out", f"{tmp_path}/ckpt"
    assert index.drain(stream, out, ckpt).count() == 2
    # t1 again: its time is behind the watermark now, so the row is late and dropped.
    publish(topic, "2.txt", tx(1), tx(2, "2025-01-01 05:30:00"), tx(3, "2025-01-01 06:00:00"))
    rows = index.drain(stream, out, ckpt)
    assert sorted(r.transaction_id for r in rows.collect()) == ["t1", "t2", "t3"]


def test_pairing_two_topics(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    publish(a, "1.txt", tx(1), tx(2), tx(3), tx("end", "2025-02-01 00:00:00"))
    publish(
        b, "1.txt",
        {"fraud_id": "f1", "transaction_id": "t1", "inference_time": "2025-01-01 00:59:00"},
        {"fraud_id": "f2", "transaction_id": "t2", "inference_time": "2025-01-01 01:01:00"},
        {"fraud_id": "end", "transaction_id": "x", "inference_time": "2025-02-01 00:00:00"},
    )
    signals = topics.parse_messages(
        topics.read_topic_files(spark, str(b)), schemas.FRAUD_SIGNAL
    ).withColumn("inference_time", F.try_to_timestamp("inference_time"))
    paired = stateful.pair_streams(timed(spark, a), signals)
    rows = index.drain(paired, f"{tmp_path}/out", f"{tmp_path}/ckpt").collect()
    got = {r.transaction_id: r.fraud_id for r in rows}
    assert got == {"t1": "f1", "t2": None, "t3": None}


def test_windows_close_behind_the_watermark(spark, tmp_path):
    topic = tmp_path / "topic"
    publish(
        topic, "1.txt", tx(1), tx(2, "2025-01-01 00:04:59", status="FAILED"),
        tx(3, "2025-01-01 00:05:00"), tx(4, "2025-01-01 03:00:00"),
    )
    stream = stateful.ops_stream(timed(spark, topic), F.col("status") == "FAILED")
    rows = index.drain(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt").collect()
    got = {str(r.window_start)[11:]: (r.throughput, r.errors) for r in rows}
    assert got == {"00:00:00": (2, 1), "00:05:00": (1, 0)}


def test_stream_plans_have_no_python(spark, tmp_path):
    topic = tmp_path / "topic"
    publish(topic, "1.txt", tx(1))
    built = index.build_stream_index(topics.read_topic_files(spark, str(topic)))
    assert "Python" not in built._jdf.queryExecution().analyzed().toString()
    assert bag(index.drain(built, f"{tmp_path}/o", f"{tmp_path}/c").select("transaction_id"))
