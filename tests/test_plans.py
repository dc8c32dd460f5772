"""What the plans look like."""

import pytest
from conftest import formatted_plan, plan_of
from pyspark.sql import functions as F

from tallyline import staging
from tallyline.functions import columns as C
from tallyline.operators import matching, reports
from tallyline.plans import lake, nested_queries, registry
from tallyline.session import configure


@pytest.fixture(scope="module", autouse=True)
def _conf(spark):
    configure(spark)


def test_no_python_on_the_hot_path(spark, data_dir):
    for name in ("match_statements", "risk_label", "policy_region", "normalize_dates",
                 "amount_usd", "merchant_aggregate", "q26_fraud_value", "user_spikes"):
        text = plan_of(registry.all_queries()[name](spark, data_dir))
        assert "EvalPython" not in text and "InPandas" not in text, name


def test_partition_filters_reach_the_scan(spark, data_dir):
    tx = lake.nested(spark, data_dir, "transactions")
    text = formatted_plan(nested_queries.promo_codes(tx, "1996-01-01", "US"))
    assert "PartitionFilters: [isnotnull(dt" in text


def test_join_on_partition_columns_prunes_both_sides(spark, data_dir):
    events = lake.nested(spark, data_dir, "user_events").where(
        "dt = '2024-01-02' AND environment = 'DEV'"
    )
    users = lake.nested(spark, data_dir, "users")
    text = formatted_plan(nested_queries.join_events_users(events, users))
    scans = [line for line in text.splitlines() if line.startswith("PartitionFilters:")]
    assert len(scans) == 2 and all("2024-01-02" in s and "DEV" in s for s in scans)


def test_nested_leaves_are_pruned(spark, data_dir):
    tx = lake.nested(spark, data_dir, "transactions")
    items = formatted_plan(nested_queries.flatten_items(tx, "1996-01-01", "US"))
    assert (
        "ReadSchema: struct<transaction_id:string,"
        "items:array<struct<sku:string,price:double,quantity:int>>>" in items
    )
    coords = nested_queries.coords_first10(tx, "1996-01-01", "US")
    assert "TakeOrderedAndProject" in plan_of(coords)
    assert "city" not in formatted_plan(coords).split("ReadSchema:")[1]


def test_filters_on_the_final_index_are_pushed(spark, data_dir):
    text = formatted_plan(reports.fraud_alerts(lake.report_index(spark, data_dir)))
    assert "GreaterThan(fraud_score,0.8)" in text


def test_column_rules_stay_in_compiled_stages(spark, data_dir):
    tx = lake.transactions(spark, data_dir)
    df = tx.select(C.amount_in_usd(F.col("amount"), F.col("currency")), C.masked_id(F.col("user_id")))
    assert "*(1) Project" in plan_of(df)


def test_dimensions_are_broadcast_only_when_they_fit(spark, data_dir):
    text = plan_of(registry.all_queries()["broadcast_dims"](spark, data_dir))
    assert "BroadcastHashJoin" in text


def test_aggregates_are_partial_before_the_shuffle(spark, data_dir):
    text = plan_of(reports.merchant_summary(lake.report_index(spark, data_dir)))
    assert "partial_count" in text and text.count("Exchange hashpartitioning") == 1


def test_match_shuffles_each_side_once(spark, data_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = matching.match_statements(
            lake.transactions(spark, data_dir), lake.statements(spark, data_dir), "x"
        )
        text = plan_of(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2 and "SortMergeJoin" in text


def test_staging_groups_before_it_joins(spark, data_dir):
    text = plan_of(staging.transactions(spark, data_dir))
    assert text.index("Join") < text.index("partial_min")




def test_items_are_gathered_after_one_shuffle_of_narrow_rows(spark, data_dir):
    """Tasks that read lines group none of them, and no maps of items are shuffled."""
    assert "map<" not in staging.order_rows(spark, data_dir).schema.simpleString()
    text = plan_of(staging.nested_transactions(spark, data_dir))
    below = text[text.index("collect_list"):]
    assert "Aggregate" not in below[below.index("Exchange hashpartitioning"):]
