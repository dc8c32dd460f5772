"""Matching, final index, reports and figures on small hand-made rows."""

from decimal import Decimal

import pytest
from conftest import bag, plan_of
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline import schemas, staging
from tallyline.operators import compliance, kpis, matching, quality, reports
from tallyline.operators.final_index import build_final_index, extend_for_reports, merge_indexes
from tallyline.operators.latest import latest_per_key
from tallyline.operators.nesting import unnest
from tallyline.sources import tables

RUN = "2025-01-19T00:00:00"


@pytest.fixture(scope="module")
def tx(spark):
    return spark.sql(
        """SELECT id AS transaction_id, m AS merchant_id, u AS user_id,
                  CAST(a AS DECIMAL(18,2)) AS amount, 'USD' AS currency, s AS status,
                  timestamp '2025-01-01 10:00:00' + make_interval(0,0,0,0,h,0,0) AS event_time,
                  p AS policy_id
           FROM VALUES ('t1','MCH-1','u1',10,'APPROVED',0,'P1'), ('t2','MCH-1','u1',20,'REFUNDED',1,'P2'),
                       ('t3',NULL,'u2',30,'DECLINED',2,NULL), ('t4','','u2',NULL,'PENDING',3,'P9')
                AS t(id, m, u, a, s, h, p)"""
    )


@pytest.fixture(scope="module")
def stmts(spark):
    return spark.sql(
        """SELECT i AS statement_id, t AS transaction_id, CAST(d AS DATE) AS posting_date,
                  CAST(a AS DECIMAL(18,2)) AS amount_posted, CAST(0.1 AS DECIMAL(18,2)) AS fee_charged
           FROM VALUES ('s1','t1','2025-01-02',10), ('s2','t2','2025-01-02',25),
                       ('s3','t2','2025-01-03',15), ('s4','gone','2025-01-02',5)
                AS s(i, t, d, a)"""
    )


@pytest.fixture(scope="module")
def signals(spark):
    return spark.createDataFrame(
        [("f1", "t1", 0.9, "v1", "2025-01-01"), ("f2", "t1", 0.2, "v1", "2025-01-02"),
         ("f3", "t3", float("nan"), "v1", "2025-01-01"), ("f4", "gone", 0.95, "v1", "2025-01-01")],
        schemas.ML_SIGNAL,
    )


def test_match_keeps_every_transaction_and_fans_out(spark, tx, stmts):
    out = matching.match_statements(tx, stmts, RUN)
    assert out.columns == matching.MATCH_COLUMNS
    rows = {(r.transaction_id, r.statement_id): r for r in out.collect()}
    assert set(rows) == {("t1", "s1"), ("t2", "s2"), ("t2", "s3"), ("t3", None), ("t4", None)}
    assert rows["t2", "s2"].discrepancy == Decimal("5.00")
    assert rows["t2", "s3"].discrepancy == Decimal("-5.00")
    assert rows["t3", None].discrepancy == 0
    assert rows["t3", None].reconciliation_status == "UNMATCHED"
    assert {r.batch_run_timestamp for r in rows.values()} == {RUN}


def test_match_dedupe_takes_the_latest_statement(tx, stmts):
    out = matching.match_statements(tx, stmts, RUN, dedupe=True).collect()
    assert {r.transaction_id: r.statement_id for r in out} == {
        "t1": "s1", "t2": "s3", "t3": None, "t4": None,
    }


def test_unmatched_both_sides(tx, stmts):
    rows = matching.unmatched_both_sides(tx, stmts).collect()
    status = {(r.transaction_id, r.statement_id): r.reconciled_status for r in rows}
    assert status == {
        ("t1", "s1"): "MATCHED", ("t2", "s2"): "MATCHED", ("t2", "s3"): "PARTIAL",
        ("t3", None): "UNMATCHED", ("t4", None): "UNMATCHED", ("gone", "s4"): "ORPHAN",
    }


def test_star_keeps_transactions(spark, tx):
    policies = spark.createDataFrame([("P1", "x")], "policy_id string, policy_name string")
    merchants = spark.createDataFrame([("MCH-1", "M")], "merchant_id string, merchant_name string")
    users = spark.createDataFrame([("u1", "U")], "user_id string, user_name string")
    out = matching.star_enrich(tx, policies, merchants, users)
    assert out.count() == 4
    assert plan_of(out).count("BroadcastHashJoin") == 3
    names = {r.transaction_id: (r.policy_name, r.merchant_name, r.user_name) for r in out.collect()}
    assert names["t1"] == ("x", "M", "U") and names["t4"] == (None, None, None)


def test_final_index_fans_out_or_dedupes(tx, stmts, signals):
    batch = matching.match_statements(tx, stmts, RUN)
    seen = tx.select("transaction_id", F.col("event_time").alias("processed_at"))
    twice = seen.unionAll(seen.where("transaction_id = 't2'"))
    plain = build_final_index(batch, signals, twice, RUN)
    counts = {r[0]: r[1] for r in plain.groupBy("transaction_id").count().collect()}
    assert counts == {"t1": 2, "t2": 4, "t3": 1, "t4": 1}
    once = build_final_index(
        matching.match_statements(tx, stmts, RUN, dedupe=True), signals, twice, RUN, dedupe=True
    )
    assert {r.transaction_id: r.fraud_signal_id for r in once.collect()} == {
        "t1": "f2", "t2": None, "t3": "f3", "t4": None,
    }


def test_extended_index_feeds_the_reports(spark, tx, stmts, signals):
    batch = matching.match_statements(tx, stmts, RUN)
    seen = tx.select("transaction_id", F.col("event_time").alias("processed_at"))
    final = build_final_index(batch, signals, seen, RUN)
    policies = spark.createDataFrame(
        [("P1", "KYC", True), ("P2", "BLACKLIST", False)],
        "policy_id string, policy_type string, active_flag boolean",
    )
    flags = compliance.policy_flags(tx, policies)
    schedule = kpis.settlement_schedule(tx, stmts, "2025-01-05")
    rep = extend_for_reports(final, tx, flags, schedule)
    assert rep.count() == final.count()
    labels = {(r.transaction_id, r.fraud_signal_id): r.risk_label for r in rep.collect()}
    assert labels["t1", "f1"] == "HIGH_RISK" and labels["t1", "f2"] == "REQUIRES_KYC"
    assert labels["t2", None] == "OK"
    assert {r.transaction_id for r in reports.settlements_due(rep).collect()} == {"t1", "t2"}


def test_merge_takes_the_newest_readable_time(spark):
    stream = spark.createDataFrame(
        [("a", "2025-01-02 00:00:00", "s"), ("b", "nonsense", "s"), ("c", None, "s"),
         ("d", "2025-01-01 00:00:00", "s")],
        "transaction_id string, timestamp string, reason_code string",
    )
    batch = spark.createDataFrame(
        [("a", "2025-01-01 00:00:00", "p"), ("b", "2025-01-01 00:00:00", "p"), ("c", "bad", "p"),
         ("e", "2025-01-01 00:00:00", "p")],
        "transaction_id string, timestamp string, policy_name string",
    )
    out = {r.transaction_id: r for r in merge_indexes(stream, batch).collect()}
    assert set(out) == set("abcde")
    assert out["a"].reason_code == "s" and out["a"].policy_name is None
    assert out["b"].policy_name == "p" and out["d"].reason_code == "s"
    assert merge_indexes(stream, batch).columns == [
        "transaction_id", "timestamp", "reason_code", "policy_name",
    ]


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS t")
    out = latest_per_key(df, ["k"], ["t"])
    assert plan_of(out).count("WindowGroupLimit") == 2
    assert bag(out) == bag(df.where("t >= 97"))


def test_reports_on_nulls_nan_and_missing_columns(spark):
    rows = [("a", 0.8, Decimal(0)), ("b", 0.81, None), ("c", float("nan"), Decimal(1)),
            ("d", None, Decimal("-1"))]
    final = spark.createDataFrame(
        rows, "transaction_id string, fraud_score double, discrepancy decimal(18,2)"
    )

    def ids(df):
        return sorted(r.transaction_id for r in df.collect())

    assert ids(reports.fraud_alerts(final)) == ["b"]
    assert ids(reports.fraud_alerts(final, 0.5)) == ["a", "b"]
    assert ids(reports.discrepancies(final)) == ["b", "c", "d"]
    assert ids(reports.compliance_cases(final)) == []
    assert ids(reports.settlements_due(final)) == []
    assert reports.settlements_due(final).columns == final.columns
    assert ids(reports.rows_of(final, "merchant_id", "x")) == []


def test_merchant_reports(spark, tx):
    rows = {r.merchant_id: r for r in reports.merchant_aggregate(tx).collect()}
    assert rows[None].total_volume == 30 and rows[None].tx_count == 1
    assert rows[""].total_volume == 0 and rows[""].average_tx == 0
    assert rows["MCH-1"].average_tx == 15.0
    first = reports.merchant_aggregate(tx).first()
    assert first.total_volume == 30
    one = reports.merchant_summary(tx, "MCH-1").collect()
    assert len(one) == 1 and (one[0].transaction_count, one[0].refund_count) == (2, 1)
    assert reports.merchant_summary(tx, "none").count() == 0
    top = [(r.merchant, r.volume) for r in reports.top_merchants(tx).collect()]
    assert top == [("MCH-1", 30), ("UNKNOWN", 30)]


def test_user_spend(tx):
    rows = {r.user_id: r for r in reports.user_spend(tx).collect()}
    assert (rows["u1"].total_spend, rows["u1"].unique_merchants) == (30, 1)
    assert (rows["u2"].total_spend, rows["u2"].unique_merchants) == (30, 1)
    assert str(rows["u2"].last_tx_time) == "2025-01-01 13:00:00"
    no_time = reports.user_spend(tx.drop("event_time"), "u1").collect()
    assert len(no_time) == 1 and no_time[0].last_tx_time is None


def test_settlement_schedule(tx, stmts):
    def status(as_of):
        rows = kpis.settlement_schedule(tx, stmts, as_of, days=2, grace=5).collect()
        return {r.transaction_id: (str(r.payout_due_date), r.payout_status) for r in rows}

    assert status("2025-01-04") == {
        "t1": ("2025-01-04", "Delayed"), "t2": ("2025-01-05", "Pending"),
    }
    assert status("2025-01-10")["t1"][1] == "Completed"


def test_user_months_and_spikes(spark):
    df = spark.sql(
        """SELECT 'u' AS user_id, concat('t', id) AS transaction_id,
                  if(id < 7, 'm1', 'm2') AS merchant_id, if(id < 2, 'DECLINED', 'APPROVED') AS status,
                  CAST(if(id = 9, 1000, 10) AS DECIMAL(18,2)) AS amount,
                  timestamp '2025-03-05 00:00:00' AS event_time FROM range(10)"""
    )
    row = kpis.user_months(df).first()
    assert (row.month, row.transactions, row.frequent_merchant) == ("2025-03", 10, "m1")
    assert row.typical_amount == 109.0 and row.repeated_declines
    assert [r.transaction_id for r in kpis.user_spikes(df).collect()] == ["t9"]


def test_ops_windows(spark):
    df = spark.sql(
        """SELECT timestamp '2025-01-01 00:00:00' + make_interval(0,0,0,0,0,CAST(id AS INT),0) AS ts,
                  if(id = 3, 'error', 'view') AS kind FROM range(10)"""
    )
    rows = kpis.ops_index(df, "ts", F.col("kind") == "error").orderBy("window_start").collect()
    assert [(r.throughput, r.errors, r.error_rate) for r in rows] == [(5, 1, 0.2), (5, 0, 0.0)]
    slid = kpis.ops_index(df, "ts", F.col("kind") == "error", size="10 minutes", slide="5 minutes")
    assert slid.agg(F.sum("throughput")).first()[0] == 20


def test_score_anomalies_find_the_jump(spark):
    df = spark.sql(
        """SELECT 'v1' AS model_version, if(id = 30, 0.9, 0.1 + 0.001 * (id % 2)) AS fraud_score,
                  timestamp '2025-01-01 00:00:00' + make_interval(0,0,0,0,CAST(id AS INT),0,0)
                      AS inference_time FROM range(40)"""
    )
    hours = [str(r.hour) for r in kpis.score_anomalies(df, sigmas=3).collect()]
    assert hours == ["2025-01-02 06:00:00"]


def test_quality_counts(spark, tx, stmts):
    row = quality.table_checks(
        stmts.unionAll(stmts.limit(1)), "st", "transaction_id", F.col("amount_posted") > 5,
        "transaction_id", tx.select("transaction_id"),
    ).first()
    assert (row.row_count, row.null_keys, row.orphans) == (5, 0, 1)
    assert (row.duplicate_keys, row.invalid_rows) == (2, 1)


def test_quality_of_an_empty_table(spark, tx, stmts):
    row = quality.table_checks(
        stmts.limit(0), "st", "transaction_id", F.lit(True), "transaction_id",
        tx.select("transaction_id"),
    ).first()
    assert (row.row_count, row.null_keys, row.duplicate_keys, row.orphans) == (0, 0, 0, 0)


def test_unnest_drops_null_and_empty_arrays(spark):
    df = spark.sql("SELECT * FROM VALUES (1, array(1,2)), (2, array()), (3, NULL) AS t(i, xs)")
    assert [tuple(r) for r in unnest(df, "xs", "x").select("i", "x").collect()] == [(1, 1), (1, 2)]


def test_typed_rows(spark):
    loose = spark.createDataFrame([("1", "x", "soon"), ("no", "2.5", "2025-01-01 00:00:00")],
                                  "a string, b string, c string")
    schema = "a bigint, b double, c timestamp, d string"
    rows = tables.typed(loose, StructType.fromDDL(schema)).collect()
    assert rows[0].a == 1 and rows[0].b is None and rows[0].c is None
    assert rows[1].a is None and rows[1].b == 2.5 and str(rows[1].c) == "2025-01-01 00:00:00"


def test_head_order(spark):
    df = spark.createDataFrame([(3,), (None,), (1,)], "a int")
    assert [r.a for r in tables.head(df, 2, ["a"]).collect()] == [1, 3]


def test_an_order_is_one_nested_row(spark, tmp_path):
    """However many line items an order has, its id and its value are whole."""
    spark.range(3000).selectExpr(
        "0L AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "CAST(id AS INT) AS l_linenumber",
        "2.0D AS l_quantity", "1.5D AS l_extendedprice",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql(
        "SELECT CAST(id AS BIGINT) AS o_orderkey, 7L AS o_custkey, "
        "timestamp_ntz '1996-05-05 00:00:00' AS o_orderdate FROM range(2)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    rows = staging.nested_transactions(spark, str(tmp_path)).select(
        "transaction_id", F.coalesce(F.array_size("items"), F.lit(0)).alias("n")
    )
    assert {r.transaction_id: r.n for r in rows.collect()} == {"0": 3000, "1": 0}


def test_quality_without_a_parent_table(stmts):
    row = quality.table_checks(stmts, "st", "statement_id", F.col("amount_posted") > 0).first()
    assert (row.row_count, row.duplicate_keys, row.invalid_rows, row.orphans) == (4, 0, 0, 0)
