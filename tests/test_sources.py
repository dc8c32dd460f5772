import json
import os

import pytest
from conftest import bag, plan_of
from pyspark.sql import functions as F

from tallyline import schemas, staging
from tallyline.session import shared_dir, work_path
from tallyline.sources import catalog, signals, sinks, tables, topics


def payloads(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


GOOD = {
    "fraud_signal_id": "f1", "transaction_id": "t1", "fraud_score": 0.85, "model_version": "v2",
    "inference_time": "2025-01-19T10:25:00",
}


def test_signal_intake(spark):
    lacking = {k: v for k, v in GOOD.items() if k != "transaction_id"}
    null_score = {**GOOD, "fraud_signal_id": "f2", "fraud_score": None}
    listed = [{**GOOD, "fraud_signal_id": "f3"}, lacking, {**GOOD, "fraud_signal_id": "f4"}]
    df = payloads(
        spark, json.dumps(GOOD), json.dumps(lacking), json.dumps(null_score),
        " " + json.dumps(listed), "[]", "not json",
    )
    accepted, rejected = signals.ingest_signals(df)
    assert accepted.schema.names == schemas.ML_SIGNAL.names
    got = {r.fraud_signal_id: r.fraud_score for r in accepted.collect()}
    assert got == {"f1": 0.85, "f2": None, "f3": 0.85, "f4": 0.85}
    errors = sorted(r.error for r in rejected.collect())
    assert errors == ["Missing field: fraud_signal_id"] + ["Missing field: transaction_id"] * 2


def test_signals_accumulate_and_snapshot(spark, tmp_path):
    accepted, _ = signals.ingest_signals(payloads(spark, json.dumps(GOOD)))
    store, out = f"{tmp_path}/store", f"{tmp_path}/snapshot"
    assert signals.store_signals(accepted, store) == 1
    signals.store_signals(accepted, store)
    stored = tables.read_table(spark, store)
    assert signals.snapshot(stored, out)
    assert tables.read_table(spark, out).count() == 2
    assert not signals.snapshot(stored.limit(0), f"{tmp_path}/none")
    assert not os.path.exists(f"{tmp_path}/none")


def test_write_counts_and_overwrites(spark, tmp_path):
    df = spark.range(10)
    assert sinks.write_table(df, f"{tmp_path}/t") == 10
    assert sinks.write_table(df.limit(4), f"{tmp_path}/t") == 4
    assert tables.read_table(spark, f"{tmp_path}/t").count() == 4


def test_partitioned_write(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 2 AS a", "id % 5 AS b")
    sinks.write_table(df, f"{tmp_path}/t", ["a", "b"])
    assert sorted(n for n in os.listdir(f"{tmp_path}/t") if "=" in n) == ["a=0", "a=1"]
    back = tables.read_table(spark, f"{tmp_path}/t", df.schema)
    assert bag(back) == bag(df)


def test_messages_keep_nulls_and_survive_bad_text(spark):
    df = spark.createDataFrame([("t1", None)], "transaction_id string, amount decimal(18,2)")
    assert sinks.as_messages(df).first().value == '{"transaction_id":"t1","amount":null}'
    keyed = sinks.as_messages(df, "transaction_id").first()
    assert keyed.key == "t1"
    raw = payloads(spark, '{"transaction_id":"a","amount":1.5}', "{oops")
    raw = raw.select(F.col("value").cast("binary").alias("value"))
    parsed = topics.parse_messages(raw, schemas.STREAM_TRANSACTION)
    rows, bad = topics.split_malformed(parsed, "transaction_id")
    assert (parsed.count(), rows.count(), bad.count()) == (2, 1, 1)
    assert str(rows.first().amount) == "1.50"


def test_kafka_reader_needs_its_package(spark):
    """The connector is not installed here: Spark itself must say so."""
    with pytest.raises(Exception, match="(?i)kafka"):
        topics.read_topic(spark, "localhost:1", "transactions_topic")


def test_counts_after_refresh(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    tables.read_table(spark, f"{tmp_path}/t").count()
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/t")
    assert tables.refresh(spark, {"t": f"{tmp_path}/t"}).collect() == [("t", 5)]


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert work_path(spark, "x") != work_path(spark, "x")


def test_nested_views_match_their_schemas(spark, data_dir):
    for name, build in staging.NESTED_VIEWS.items():
        have = [(f.name, f.dataType.simpleString()) for f in build(spark, data_dir).schema.fields]
        want = [(f.name, f.dataType.simpleString()) for f in schemas.NESTED[name].fields]
        assert have == want, name


@pytest.fixture(scope="module")
def locations(spark, data_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("lake"))
    sinks.write_table(
        staging.nested_locations(spark, data_dir), f"{base}/locations", ["dt", "environment"]
    )
    spark.sql("DROP DATABASE IF EXISTS lake_test CASCADE")
    return catalog.register_tables(spark, base, "lake_test", ["locations"])[0]


def test_partitions_appear_after_repair(spark, locations):
    assert spark.table(locations).count() == 0
    catalog.add_partition(spark, locations, dt="2024-01-01", environment="DEV")
    assert catalog.show_partitions(spark, locations).count() == 1
    one = spark.table(locations).count()
    catalog.repair(spark, locations)
    assert 0 < one < spark.table(locations).count() == 150
    meta = catalog.partitions_metadata(spark, locations)
    assert meta.columns == ["dt", "environment"] and meta.count() == 6
    assert "FileScan" not in plan_of(meta)
    latest = catalog.latest_partition(spark, locations, "environment").collect()
    assert {r.environment: r.latest_dt for r in latest} == {
        "DEV": "2024-01-03", "PROD": "2024-01-03",
    }


def test_partition_columns_stay_text(spark, locations):
    assert dict(spark.table(locations).dtypes)["dt"] == "string"


def test_explain_shows_the_partition_filter(spark, locations):
    text = catalog.explain(
        spark, f"SELECT location_id FROM {locations} WHERE dt = '2024-01-01' "
        "AND environment = 'DEV'"
    ).first()[0]
    assert "PartitionFilters" in text and "dt" in text.split("PartitionFilters")[1]


def test_no_payload_vanishes(spark):
    from tallyline.sources import signals

    texts = ['[{"fraud_signal_id": ', "[]", "7", "", None, '{"bad', '[{"fraud_signal_id": "1"}]']
    payloads = spark.createDataFrame([(t,) for t in texts], "value string")
    accepted, rejected = signals.ingest_signals(payloads)
    assert accepted.count() + rejected.count() == len(texts) - 1  # the empty list has none


def test_partition_values_are_unescaped(spark, tmp_path):
    import uuid

    from tallyline.sources import catalog

    name = f"t_{uuid.uuid4().hex[:8]}"
    rows = [(1, "2024-01-01", "N/A"), (2, "2024-01-01", "a=b"), (3, "2024-01-02", "x+y")]
    spark.createDataFrame(rows, "id int, dt string, region string").write.partitionBy(
        "dt", "region"
    ).saveAsTable(name)
    got = catalog.partitions_metadata(spark, name).collect()
    assert {(r.dt, r.region) for r in got} == {(dt, region) for _, dt, region in rows}
