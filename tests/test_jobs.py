"""The jobs chained from path to path on small tables."""

import json

from tallyline.plans import jobs
from tallyline.session import size_shuffles


def put(spark, path, sql):
    spark.sql(sql).write.parquet(path)
    return path


def test_chain_from_payloads_to_the_final_index(spark, tmp_path):
    d = str(tmp_path)
    stream = put(
        spark, f"{d}/stream",
        """SELECT t AS transaction_id, 'm' AS merchant_id, 'u' AS user_id,
                  CAST(10 AS DECIMAL(18,2)) AS amount, 'USD' AS currency, 'APPROVED' AS status,
                  timestamp '2025-01-01 00:00:05' AS processed_at
           FROM VALUES ('t1'), ('t2') AS x(t)""",
    )
    statements = put(
        spark, f"{d}/statements",
        """SELECT 's1' AS statement_id, 't1' AS transaction_id, date '2025-01-02' AS posting_date,
                  CAST(12 AS DECIMAL(18,2)) AS amount_posted,
                  CAST(0.1 AS DECIMAL(18,2)) AS fee_charged""",
    )
    signal = {"fraud_signal_id": "f1", "transaction_id": "t2", "fraud_score": 0.9,
              "model_version": "v1", "inference_time": "2025-01-01T00:00:00"}
    (tmp_path / "posted").mkdir()
    (tmp_path / "posted" / "1.json").write_text(json.dumps(signal) + '\n{"fraud_signal_id":"x"}\n')
    assert jobs.intake_job(spark, f"{d}/posted", f"{d}/store", f"{d}/rejected") == (1, 1)
    assert jobs.snapshot_signals_job(spark, f"{d}/store", f"{d}/signals")
    assert jobs.match_job(spark, stream, statements, f"{d}/batch") == 2
    n = jobs.final_index_job(spark, f"{d}/batch", f"{d}/signals", stream, f"{d}/final", "now")
    assert n == 2
    rows = {r.transaction_id: r for r in spark.read.parquet(f"{d}/final").collect()}
    assert float(rows["t1"].discrepancy) == 2.0 and rows["t1"].fraud_score is None
    assert rows["t2"].reconciliation_status == "UNMATCHED" and rows["t2"].fraud_score == 0.9
    assert rows["t2"].final_index_ts == "now" and rows["t2"].processed_at is not None
    assert jobs.final_index_job(
        spark, f"{d}/batch", f"{d}/signals", stream, f"{d}/final", dedupe=True
    ) == 2


def test_star_and_merge(spark, tmp_path):
    d = str(tmp_path)
    tx = put(
        spark, f"{d}/tx",
        """SELECT 't1' AS transaction_id, 'u1' AS user_id, 'm1' AS merchant_id,
                  '2025-01-01 00:00:00' AS timestamp, CAST(1 AS DECIMAL(18,2)) AS amount,
                  'p1' AS policy_id""",
    )
    policies = put(spark, f"{d}/p", "SELECT 'p1' AS policy_id, 'P' AS policy_name")
    merchants = put(spark, f"{d}/m", "SELECT 'm1' AS merchant_id, 'M' AS merchant_name")
    users = put(spark, f"{d}/u", "SELECT 'u0' AS user_id, 'U' AS user_name")
    assert jobs.star_index_job(spark, tx, policies, merchants, users, f"{d}/star") == 1
    row = spark.read.parquet(f"{d}/star").first()
    assert (row.policy_name, row.merchant_name, row.user_name) == ("P", "M", None)
    stream = put(
        spark, f"{d}/s",
        "SELECT 't1' AS transaction_id, '2025-01-02 00:00:00' AS timestamp, 'f1' AS fraud_id",
    )
    assert jobs.merge_job(spark, stream, f"{d}/star", f"{d}/merged") == 1
    assert spark.read.parquet(f"{d}/merged").first().fraud_id == "f1"


def test_shuffles_are_sized_by_the_input(spark, tmp_path):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    spark.range(100_000).write.parquet(f"{tmp_path}/t")
    assert size_shuffles(spark, f"{tmp_path}/t", bytes_each=1000) > 100
    assert int(spark.conf.get(setting)) > 100
    assert size_shuffles(spark, f"{tmp_path}/t", bytes_each=1000, most=50) == 50
    assert size_shuffles(spark, f"{tmp_path}/t") == 4
    assert spark.conf.get(setting, None) is None
