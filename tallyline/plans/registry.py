"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas, staging
from ..operators import (
    compliance,
    enrichment,
    kpis,
    matching,
    nesting,
    quality,
    quantiles,
    reports,
    runs,
    versioned_index,
)
from ..operators.final_index import merge_indexes
from ..operators.latest import latest_per_key
from ..operators.skew import attach, skew_join
from ..session import work_path
from ..sources import catalog, signals, sinks, tables, topics
from ..streaming import index as stream
from ..streaming import stateful
from . import lake
from . import nested_queries as nq

Query = Callable[[SparkSession, str], DataFrame]

# Partition values of the nested queries.
TX_DT, DAY = "1996-01-01", "2024-01-02"
MERCHANT, USER = "MCH-A4", "USR-7"

_queries: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Plain doubles, long integers and text, which any engine can compare."""
    out = []
    for f in df.schema.fields:
        c, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c, ",")
        elif isinstance(kind, (T.MapType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            sf_dir = sf_dir.rstrip("/")
            lake.prepare(spark, sf_dir)
            return portable(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _queries[name] = run
        return fn

    return register


def all_queries() -> dict[str, Query]:
    return dict(_queries)


# --- sources and sinks ----------------------------------------------------------


@query("scan_parquet")
def _(spark, d):
    orders = tables.test_table(spark, d, "orders")
    return orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def published_transactions(spark, d, copies: bool = False) -> str:
    """Transactions as JSON messages in a fresh folder; `copies` sends some twice."""
    tx = lake.transactions(spark, d)
    if copies:
        twice = F.col("transaction_id").cast("bigint") % 50 == 1
        times = F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
        tx = tx.withColumn("copy", F.explode(times)).drop("copy")
    path = work_path(spark, "topic")
    sinks.publish_json(tx, directory=path)
    return path


def published_signals(spark, d) -> str:
    path = work_path(spark, "topic")
    sent = staging.fraud_signals(spark, d).select(
        F.col("fraud_signal_id").alias("fraud_id"), "transaction_id", "model_version",
        F.col("fraud_score_100").alias("fraud_score"), "inference_time", "reason_code",
    )
    sinks.publish_json(sent, directory=path)
    return path


TX_FIELDS = ["transaction_id", "merchant_id", "user_id", "amount", "currency", "status"]


@query("stream_json_source")
def _(spark, d):
    messages = topics.read_topic_files(spark, published_transactions(spark, d))
    raw = topics.payload_text(messages)
    out = stream.drain(raw, work_path(spark, "out"), work_path(spark, "ckpt"))
    return out.select(
        F.get_json_object("json", "$.transaction_id").alias("transaction_id"),
        F.get_json_object("json", "$.status").alias("status"),
    )


@query("publish_json")
def _(spark, d):
    sent = spark.read.text(published_transactions(spark, d))
    return topics.parse_messages(sent, schemas.STREAM_TRANSACTION).select(*TX_FIELDS)


def posted_payloads(spark, d) -> DataFrame:
    """Signals as clients post them: some incomplete, some with a null, some as lists."""
    sig = staging.fraud_signals(spark, d)
    n = F.col("fraud_signal_id").cast("bigint") % 10

    def record(id_suffix: str, *fields):
        head = F.concat("fraud_signal_id", F.lit(id_suffix)).alias("fraud_signal_id")
        rest = ["transaction_id", "model_version", "inference_time"]
        return F.to_json(F.struct(head, *rest, *fields), {"ignoreNullFields": "false"})

    score = F.col("fraud_score")
    no_score = F.lit(None).cast("double").alias("fraud_score")
    return sig.select(
        F.when(n == 0, record(""))
        .when(n == 1, record("", no_score))
        .when(n == 2, F.concat(F.lit("["), record("", score), F.lit(", "), record("-b", score),
                               F.lit("]")))
        .otherwise(record("", score))
        .alias("value")
    )


@query("ingest_signals")
def _(spark, d):
    accepted, rejected = signals.ingest_signals(posted_payloads(spark, d))
    return accepted.select(
        "fraud_signal_id", "transaction_id", "fraud_score", "model_version",
        F.lit("accepted").alias("outcome"),
    ).unionByName(
        rejected.select(
            F.get_json_object("record", "$.fraud_signal_id").alias("fraud_signal_id"),
            F.col("error").alias("outcome"),
        ),
        allowMissingColumns=True,
    )


@query("snapshot_signals")
def _(spark, d):
    accepted, _rejected = signals.ingest_signals(posted_payloads(spark, d))
    store, path = work_path(spark, "signals"), work_path(spark, "snapshot")
    signals.store_signals(accepted, store)
    signals.snapshot(tables.read_table(spark, store), path)
    return tables.read_table(spark, path, schemas.ML_SIGNAL).drop("inference_time")


@query("write_overwrite")
def _(spark, d):
    tx, path = lake.transactions(spark, d), work_path(spark, "table")
    sinks.write_table(tx, path)
    sinks.write_table(tx, path)
    return tables.read_table(spark, path)


@query("write_partitioned")
def _(spark, d):
    path = work_path(spark, "table")
    sinks.write_table(lake.transactions(spark, d), path, ["currency", "status"])
    return tables.read_table(spark, path)


@query("stream_parquet_sink")
def _(spark, d):
    messages = topics.read_topic_files(spark, published_signals(spark, d))
    parsed = topics.parse_messages(messages, schemas.FRAUD_SIGNAL)
    return stream.drain(parsed, work_path(spark, "out"), work_path(spark, "ckpt"))


@query("register_tables")
def _(spark, d):
    names = {t: lake.registered(spark, d, t) for t in schemas.NESTED}
    return tables.row_counts({t: spark.table(name) for t, name in names.items()})


@query("repair_partitions")
def _(spark, d):
    """Rows of each table before and after looking for partition directories."""
    counts = []
    for table, parts in ((t, schemas.partition_columns(t)) for t in schemas.NESTED):
        name = lake.unrepaired(spark, d, table)
        before = spark.table(name).count()
        catalog.repair(spark, name)
        counts.append(
            spark.table(name)
            .groupBy(*parts)
            .agg(F.count("*").alias("n"))
            .agg(F.count("*").alias("partitions"), F.sum("n").alias("rows_after"))
            .select(
                F.lit(table).alias("dataset"), F.lit(before).alias("rows_before"),
                "partitions", "rows_after",
            )
        )
    return reduce(DataFrame.unionAll, counts)


@query("typed_rows")
def _(spark, d):
    key = F.col("event_id")
    loose = tables.test_table(spark, d, "events").select(
        key.cast("string").alias("fraud_id"),
        F.when(key % 11 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("fraud_score"),
        F.when(key % 13 == 0, "soon")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("inference_time"),
    )
    schema = T.StructType(
        [
            T.StructField("fraud_id", T.LongType()),
            T.StructField("fraud_score", T.DoubleType()),
            T.StructField("inference_time", T.TimestampType()),
            T.StructField("reason_code", T.StringType()),
        ]
    )
    return tables.typed(loose, schema)


@query("preview_head")
def _(spark, d):
    final = lake.final_index(spark, d).drop("inference_time")
    return tables.head(final, 50, ["transaction_id", "fraud_signal_id"])


@query("reload_counts")
def _(spark, d):
    paths = {n: f"{d}/{n}.parquet" for n in ("orders", "lineitem", "events")}
    return tables.refresh(spark, paths)


# --- projections and filters ----------------------------------------------------


@query("project_columns")
def _(spark, d):
    return lake.batch_index(spark, d).select(
        "transaction_id", "merchant_id", "user_id", "amount", "currency", "status",
        "discrepancy", "reconciliation_status",
    )


@query("flatten_struct_star")
def _(spark, d):
    packed = lake.transactions(spark, d).select(F.struct(*TX_FIELDS).alias("data"))
    return packed.select("data.*")


@query("stamp_run")
def _(spark, d):
    tx = lake.transactions(spark, d).select("transaction_id", "amount")
    return matching.stamp_run(tx, lake.RUN_TS, "batch_run_timestamp")


@query("stamp_processing_time")
def _(spark, d):
    messages = topics.read_topic_files(spark, published_transactions(spark, d))
    out = stream.drain(
        stream.build_stream_index(messages), work_path(spark, "out"), work_path(spark, "ckpt")
    )
    return out.select("transaction_id", F.col("processed_at").isNotNull().alias("is_stamped"))


@query("cast_payload")
def _(spark, d):
    raw = lake.transactions(spark, d).select(F.col("transaction_id").cast("binary").alias("value"))
    return topics.payload_text(raw)


@query("rename_drop")
def _(spark, d):
    return (
        lake.transactions(spark, d)
        .withColumnsRenamed({"amount": "total_volume", "event_time": "occurred_at"})
        .drop("policy_id", "occurred_at")
    )


@query("filter_partition_eq")
def _(spark, d):
    tx = nesting.heads(lake.nested(spark, d, "transactions"))
    return catalog.select_partition(tx, dt=TX_DT, region="EU").select(
        "transaction_id", "user_id", "dt", "region"
    )


REPORT_FIELDS = ["transaction_id", "merchant_id", "user_id", "amount", "fraud_signal_id"]


@query("fraud_alerts")
def _(spark, d):
    return reports.fraud_alerts(lake.report_index(spark, d)).select(*REPORT_FIELDS, "fraud_score")


@query("discrepancies")
def _(spark, d):
    return reports.discrepancies(lake.report_index(spark, d)).select(
        *REPORT_FIELDS, "discrepancy", "reconciliation_status"
    )


@query("compliance_cases")
def _(spark, d):
    return reports.compliance_cases(lake.report_index(spark, d)).select(
        *REPORT_FIELDS, "risk_label"
    )


@query("settlements_due")
def _(spark, d):
    return reports.settlements_due(lake.report_index(spark, d)).select(
        *REPORT_FIELDS, "payout_due_date"
    )


@query("column_guard")
def _(spark, d):
    """Spend by user over an index without amounts: all zero, not an error."""
    return reports.user_spend(lake.report_index(spark, d).drop("amount")).select(
        "user_id", "total_spend", "unique_merchants"
    )


@query("merchant_rows")
def _(spark, d):
    return reports.rows_of(lake.report_index(spark, d), "merchant_id", MERCHANT).select(
        *REPORT_FIELDS
    )


@query("user_rows")
def _(spark, d):
    return reports.rows_of(lake.report_index(spark, d), "user_id", USER).select(*REPORT_FIELDS)


@query("literal_tag")
def _(spark, d):
    return lake.transactions(spark, d).select(
        "transaction_id", F.lit("transactions").alias("source")
    )


@query("case_status")
def _(spark, d):
    return lake.batch_index(spark, d).select(
        "transaction_id", "statement_id", "reconciliation_status"
    )


# --- joins ----------------------------------------------------------------------


@query("star_enrich")
def _(spark, d):
    return matching.star_enrich(
        lake.transactions(spark, d),
        staging.policies(spark).select(
            "policy_id", "policy_name", "effective_date", "policy_details"
        ),
        staging.merchants(spark, d),
        staging.users(spark, d),
    )


@query("match_statements")
def match_statements(spark, d):
    return matching.match_statements(
        lake.transactions(spark, d), lake.statements(spark, d), lake.RUN_TS
    )


@query("match_statements_deduped")
def _(spark, d):
    return matching.match_statements(
        lake.transactions(spark, d), lake.statements(spark, d), lake.RUN_TS, dedupe=True
    )


@query("final_index")
def _(spark, d):
    return lake.final_index(spark, d)


@query("stream_static_enrich")
def _(spark, d):
    messages = topics.read_topic_files(spark, published_signals(spark, d))
    tx = lake.transactions(spark, d).select("transaction_id", "user_id", "merchant_id", "amount")
    joined = stream.enrich_stream(messages, tx).drop("inference_time")
    return stream.drain(joined, work_path(spark, "out"), work_path(spark, "ckpt"))


@query("join_partition_aligned")
def _(spark, d):
    return nq.join_events_users(
        lake.nested(spark, d, "user_events").select("event_id", "user_id", "dt", "environment"),
        lake.nested(spark, d, "users").select("user_id", "dt", "environment", "status"),
    )


@query("join_signals_tx")
def _(spark, d):
    return nq.signals_with_transactions(
        lake.nested(spark, d, "fraud_signals"),
        nesting.heads(lake.nested(spark, d, "transactions")).select("transaction_id", "user_id"),
    )


@query("cross_join_unnest")
def _(spark, d):
    tx = lake.nested(spark, d, "transactions")
    rows = nesting.unnest(tx, "items", "item", ["sku", "quantity"])
    return rows.select("transaction_id", "item.sku", "item.quantity")


# --- aggregations ---------------------------------------------------------------


@query("count_by_status")
def _(spark, d):
    return nq.count_by(lake.nested(spark, d, "users"), "status", "total_users")


@query("count_by_device")
def _(spark, d):
    events = lake.nested(spark, d, "user_events")
    return nq.count_by(events, "event_info.device", "total_events", "device_type")


@query("order_value_top5")
def _(spark, d):
    values = nq.order_values(lake.nested(spark, d, "transactions"))
    return values.orderBy(F.col("total_order_value").desc(), "transaction_id").limit(5)


@query("fraud_value_having")
def _(spark, d):
    return nq.signal_values(
        lake.nested(spark, d, "fraud_signals"), lake.nested(spark, d, "transactions")
    )


@query("distinct_colors")
def _(spark, d):
    return nq.colors(lake.nested(spark, d, "transactions"))


@query("merchant_aggregate")
def _(spark, d):
    return reports.merchant_aggregate(lake.report_index(spark, d))


@query("merchant_summary")
def _(spark, d):
    return reports.merchant_summary(lake.report_index(spark, d))


@query("merchant_summary_one")
def _(spark, d):
    return reports.merchant_summary(lake.report_index(spark, d), MERCHANT)


@query("user_spend")
def _(spark, d):
    return reports.user_spend(lake.report_index(spark, d))


@query("row_counts")
def _(spark, d):
    return tables.row_counts(
        {
            "batch_index": lake.batch_index(spark, d),
            "final_index": lake.final_index(spark, d),
            "stream_index": lake.stream_index(spark, d),
        }
    )


@query("top5_merchants")
def _(spark, d):
    return reports.top_merchants(lake.report_index(spark, d))


# --- windows, sorts, set operations ---------------------------------------------


@query("latest_per_transaction")
def _(spark, d):
    """Newest statement of each transaction."""
    return latest_per_key(
        lake.statements(spark, d), ["transaction_id"], ["posting_date"], ["statement_id"]
    )


@query("number_user_events")
def _(spark, d):
    return nq.number_events(lake.nested(spark, d, "user_events"))


@query("top5_merchants_by_rating")
def _(spark, d):
    return nq.top_rated(lake.nested(spark, d, "merchants"))


@query("coords_first10")
def _(spark, d):
    return (
        nesting.heads(lake.nested(spark, d, "transactions"))
        .select("transaction_id", "location_info.coords.lat", "location_info.coords.lon")
        .orderBy("transaction_id")
        .limit(10)
    )


@query("order_partitions")
def _(spark, d):
    events = lake.nested(spark, d, "user_events")
    return (
        events.groupBy("dt", "environment").agg(F.count("*").alias("n"))
        .orderBy("dt", "environment")
    )


@query("merchant_ranking")
def _(spark, d):
    return reports.merchant_aggregate(lake.report_index(spark, d)).select(
        "merchant_id", "total_volume"
    )


def _stream_and_batch(spark, d) -> tuple[DataFrame, DataFrame]:
    """Two indexes of the transactions, which do not agree in times and columns."""
    tx = lake.transactions(spark, d)
    timed = tx.withColumn("timestamp", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))
    base = timed.select(
        "transaction_id", "user_id", "merchant_id", "timestamp", "amount", "currency", "status"
    )
    later = F.date_format(
        F.col("event_time") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss"
    )
    key = F.col("transaction_id").cast("bigint")
    # The stream saw two thirds of the transactions, a third of those a day
    # later than the batch, and one row in seven with an unreadable time.
    seen = (
        timed.where(key % 3 != 0)
        .withColumn("timestamp", F.when(key % 3 == 1, later).otherwise(F.col("timestamp")))
        .withColumn("timestamp", F.when(key % 7 == 0, "unknown").otherwise(F.col("timestamp")))
        .select(*base.columns, F.lit("stream").alias("reason_code"))
    )
    return seen, base.withColumn("policy_name", F.lit("batch"))


@query("merge_indexes")
def _(spark, d):
    return merge_indexes(*_stream_and_batch(spark, d))


@query("merge_indexes_incremental")
def _(spark, d):
    """The same in three merges into an index kept in buckets."""
    seen, enriched = _stream_and_batch(spark, d)
    odd = F.col("transaction_id").cast("bigint") % 2 == 1
    base, newest = work_path(spark, "index"), [F.try_to_timestamp("timestamp")]
    for rows in (seen.where(odd), enriched, seen.where(~odd)):
        versioned_index.merge_increment(rows, base, newest)
    return versioned_index.read_index(spark, base)


@query("union_coords")
def _(spark, d):
    return nq.union_coords(
        nesting.heads(lake.nested(spark, d, "transactions")), lake.nested(spark, d, "locations")
    )


# --- enrichment -----------------------------------------------------------------


@query("label_fraud_score")
def _(spark, d):
    return enrichment.score_label_counts(staging.fraud_signals(spark, d))


@query("mask_user_names")
def _(spark, d):
    return enrichment.with_masked_name(staging.users(spark, d).select("user_id", "user_name"))


@query("policy_region")
def _(spark, d):
    policies = enrichment.with_policy_region(staging.policies(spark))
    tx = lake.transactions(spark, d).select("transaction_id", "policy_id")
    return attach(tx, policies.select("policy_id", "policy_region"), "policy_id")


@query("amount_usd")
def _(spark, d):
    tx = lake.transactions(spark, d).select("transaction_id", "amount", "currency")
    return enrichment.with_amount_usd(tx)


@query("round_amounts")
def _(spark, d):
    posted = skew_join(
        lake.transactions(spark, d).select("transaction_id"),
        staging.fraud_signals(spark, d).select(
            "transaction_id", (F.col("fraud_score_100") * 1).cast("decimal(18,6)").alias("amount")
        ),
        "transaction_id", "left",
    ).withColumn("amount", F.col("amount") / 8)
    return enrichment.with_rounded_amount(posted)


@query("normalize_dates")
def _(spark, d):
    return enrichment.with_iso_date(staging.users(spark, d).select("user_id", "signup_date"))


@query("discrepancy")
def _(spark, d):
    joined = skew_join(
        lake.transactions(spark, d).select("transaction_id", "amount"),
        lake.statements(spark, d).select("transaction_id", "statement_id", "amount_posted"),
        "transaction_id", "left",
    )
    return enrichment.with_discrepancy(joined)


@query("risk_label")
def _(spark, d):
    return lake.report_index(spark, d).select(
        "transaction_id", "fraud_signal_id", "fraud_score", "risk_label"
    )


@query("mask_ids")
def _(spark, d):
    return enrichment.with_masked_id(lake.transactions(spark, d).select("transaction_id", "user_id"))


@query("derive_status")
def _(spark, d):
    batch = lake.batch_index(spark, d).select(
        "transaction_id", "statement_id", "status", "reconciliation_status"
    )
    return enrichment.with_final_status(batch)


@query("merchant_kpi")
def _(spark, d):
    return enrichment.daily_merchant_kpi(lake.transactions(spark, d))


# --- streaming ------------------------------------------------------------------


@query("stream_index_tx")
def _(spark, d):
    messages = topics.read_topic_files(spark, published_transactions(spark, d))
    built = stream.build_stream_index(messages)
    out = stream.drain(built, work_path(spark, "out"), work_path(spark, "ckpt"))
    return out.drop("processed_at")


@query("stream_index_fraud")
def _(spark, d):
    messages = topics.read_topic_files(spark, published_signals(spark, d))
    tx = lake.transactions(spark, d).withColumn(
        "timestamp", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")
    )
    joined = stream.enrich_stream(messages, tx.drop("event_time")).drop("inference_time")
    return stream.drain(joined, work_path(spark, "out"), work_path(spark, "ckpt"))


@query("stream_enrich_changing")
def _(spark, d):
    """Transactions merged into the index between two batches are found by the second."""
    tx = lake.transactions(spark, d).select("transaction_id", "amount", "status")
    key, base = F.col("transaction_id").cast("bigint"), work_path(spark, "index")
    even = F.col("fraud_signal_id").cast("bigint") % 2 == 0
    sent = staging.fraud_signals(spark, d).select("fraud_signal_id", "transaction_id", "fraud_score")
    topic, out, ckpt = (work_path(spark, n) for n in ("topic", "out", "ckpt"))

    def lookup(keys: DataFrame) -> DataFrame:
        return versioned_index.read_index(keys.sparkSession, base, keys)

    for rows, signals_sent in ((tx.where(key % 3 != 0), sent.where(even)), (tx, sent.where(~even))):
        versioned_index.merge_increment(rows, base, [])
        sinks.publish_json(signals_sent, directory=topic)
        arriving = topics.parse_messages(
            topics.read_topic_files(spark, topic),
            "fraud_signal_id string, transaction_id string, fraud_score double",
        )
        stream.enrich_batches(
            arriving, lookup, out, ckpt, trigger={"availableNow": True}
        ).awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query("stream_checkpoint")
def _(spark, d):
    """Two runs over one checkpoint: the second finds nothing new."""
    messages = topics.read_topic_files(spark, published_transactions(spark, d))
    parsed = topics.parse_messages(messages, schemas.STREAM_TRANSACTION)
    out, ckpt = work_path(spark, "out"), work_path(spark, "ckpt")
    stream.drain(parsed, out, ckpt)
    return stream.drain(parsed, out, ckpt).select("transaction_id", "amount", "status")


@query("stream_append_mode")
def _(spark, d):
    """Messages arriving in two steps; the second run appends to the first."""
    topic = published_transactions(spark, d)
    parsed = topics.parse_messages(
        topics.read_topic_files(spark, topic), schemas.STREAM_TRANSACTION
    )
    out, ckpt = work_path(spark, "out"), work_path(spark, "ckpt")
    stream.drain(parsed, out, ckpt)
    sinks.publish_json(lake.transactions(spark, d), directory=topic)
    rows = stream.drain(parsed, out, ckpt)
    return rows.groupBy("transaction_id").agg(F.count("*").alias("arrivals"))


@query("stream_triggers")
def _(spark, d):
    """The running job at a fixed interval, stopped once it has caught up."""
    messages = topics.read_topic_files(spark, published_transactions(spark, d))
    out = work_path(spark, "out")
    job = stream.transaction_index_job(messages, out, work_path(spark, "ckpt"), "1 second")
    job.processAllAvailable()
    job.stop()
    return tables.read_table(spark, out).select("transaction_id", "status")


@query("stream_dedup")
def _(spark, d):
    messages = topics.read_topic_files(spark, published_transactions(spark, d, copies=True))
    parsed = topics.parse_messages(messages, schemas.STREAM_TRANSACTION).withColumn(
        "event_time", F.try_to_timestamp("event_time")
    )
    once = stateful.dedupe_stream(parsed)
    return stream.drain(once, work_path(spark, "out"), work_path(spark, "ckpt"))


@query("stream_stream_enrich")
def _(spark, d):
    """Signals follow their transactions by up to 89 minutes; an hour counts."""
    tx = lake.transactions(spark, d).select("transaction_id", "event_time")
    followed = skew_join(
        staging.fraud_signals(spark, d).select("fraud_signal_id", "transaction_id", "fraud_score"),
        tx, "transaction_id",
    ).select(
        "fraud_signal_id", "transaction_id", "fraud_score",
        F.expr("event_time + make_interval(0, 0, 0, 0, 0, "
               "cast(fraud_signal_id as bigint) % 90, 0)").alias("inference_time"),
    )
    # One late message per topic moves both watermarks past all others.
    end = F.lit("2030-01-01").cast("timestamp_ntz")
    last_tx = tx.limit(1).select(F.lit("end-of-topic").alias("transaction_id"),
                                 end.alias("event_time"))
    last_signal = tx.limit(1).select(
        F.lit("end").alias("fraud_signal_id"), F.lit("none").alias("transaction_id"),
        F.lit(0.0).alias("fraud_score"), end.alias("inference_time"),
    )
    tx_topic, signal_topic = work_path(spark, "topic"), work_path(spark, "topic")
    sinks.publish_json(tx.unionByName(last_tx), directory=tx_topic)
    sinks.publish_json(followed.unionByName(last_signal), directory=signal_topic)

    tx_schema = "transaction_id string, event_time timestamp"
    signal_schema = (
        "fraud_signal_id string, transaction_id string, fraud_score double, "
        "inference_time timestamp"
    )
    paired = stateful.pair_streams(
        topics.parse_messages(topics.read_topic_files(spark, tx_topic), tx_schema),
        topics.parse_messages(topics.read_topic_files(spark, signal_topic), signal_schema),
    )
    out = stream.drain(paired, work_path(spark, "out"), work_path(spark, "ckpt"))
    return out.where("transaction_id <> 'end-of-topic'").select(
        "transaction_id", "fraud_signal_id", "fraud_score"
    )


# --- designed figures -----------------------------------------------------------

def _ops_events(spark, d) -> DataFrame:
    return tables.test_table(spark, d, "events").select(
        F.col("ts").alias("event_time"), "event_type",
        F.col("value").cast("decimal(18,2)").alias("latency"),
    )


@query("ops_index")
def _(spark, d):
    return kpis.ops_index(
        _ops_events(spark, d), "event_time", F.col("event_type") == "error", F.col("latency")
    )


@query("ops_index_sliding")
def _(spark, d):
    return kpis.ops_index(
        _ops_events(spark, d), "event_time", F.col("event_type") == "error", F.col("latency"),
        size="10 minutes", slide="5 minutes",
    )


@query("ops_latency_tails")
def _(spark, d):
    """Hourly tails from 5-minute sketches, with the largest error of their ranks."""
    events, latency = _ops_events(spark, d), F.col("latency")
    sketches = lake.landed(
        spark, d, "latency_sketches",
        lambda: quantiles.window_sketches(events, "event_time", latency),
    )
    hourly = quantiles.tails(quantiles.roll_up(sketches))
    errors = quantiles.rank_errors(events, "event_time", latency, hourly)
    close = F.greatest(*[F.col(f"{name}_error") for name in quantiles.TAILS]) < 0.01
    return errors.select("window_start", "values", close.alias("within_one_percent"))


@query("ops_index_stream")
def _(spark, d):
    """Windows closed by the watermark: all that end an hour before the last event."""
    topic = work_path(spark, "topic")
    sinks.publish_json(_ops_events(spark, d), directory=topic)
    events = topics.parse_messages(
        topics.read_topic_files(spark, topic), "event_time timestamp, event_type string"
    )
    closed = stateful.ops_stream(events, F.col("event_type") == "error")
    out = stream.drain(closed, work_path(spark, "out"), work_path(spark, "ckpt"))
    return out.select("window_start", "throughput", "errors")


@query("broadcast_dims")
def _(spark, d):
    tx = lake.transactions(spark, d).select("transaction_id", "merchant_id", "amount")
    return attach(tx, staging.merchants(spark, d), "merchant_id")


@query("salted_join")
def _(spark, d):
    """Events with their users; every sizeable user is cut into slices."""
    events = tables.test_table(spark, d, "events").select("event_id", "user_id", "value")
    users = tables.test_table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name"
    )
    return skew_join(events, users, "user_id", "left", share=0.001, min_rows=2)


@query("unmatched_both_sides")
def _(spark, d):
    return matching.unmatched_both_sides(lake.transactions(spark, d), lake.statements(spark, d))


@query("merchant_daily_kpi")
def _(spark, d):
    return kpis.merchant_daily_kpi(lake.report_index(spark, d))


@query("user_profile")
def _(spark, d):
    return kpis.user_months(lake.transactions(spark, d))


@query("user_decline_runs")
def _(spark, d):
    return runs.decline_runs(lake.transactions(spark, d))


@query("user_typical_amounts")
def _(spark, d):
    return quantiles.typical_amounts(lake.transactions(spark, d))


@query("user_spikes")
def _(spark, d):
    return kpis.user_spikes(lake.transactions(spark, d))


def _schedule(spark, d) -> DataFrame:
    return kpis.settlement_schedule(
        lake.transactions(spark, d), lake.statements(spark, d), lake.AS_OF
    )


@query("settlement_schedule")
def _(spark, d):
    return _schedule(spark, d)


@query("settlements_by_merchant")
def _(spark, d):
    return kpis.settlements_by_merchant(_schedule(spark, d))


@query("compliance_index")
def _(spark, d):
    return compliance.compliance_index(
        lake.transactions(spark, d), staging.policies(spark), staging.fraud_signals(spark, d)
    )


@query("quality_report")
def _(spark, d):
    tx, st = lake.transactions(spark, d), lake.statements(spark, d)
    sig = staging.fraud_signals(spark, d)
    return quality.quality_report(
        [
            quality.table_checks(
                tx, "transactions", "transaction_id",
                (F.col("amount") > 0) & F.col("merchant_id").isNotNull(),
                "user_id", staging.users(spark, d).select("user_id"),
            ),
            quality.table_checks(
                st, "statements", "transaction_id", F.col("amount_posted") >= F.col("fee_charged"),
                "transaction_id", tx.select("transaction_id"),
            ),
            quality.table_checks(
                sig, "fraud_signals", "model_version", F.col("fraud_score").between(0, 1),
                "transaction_id", tx.select("transaction_id"),
            ),
        ]
    )


@query("fraud_score_anomalies")
def _(spark, d):
    return kpis.score_anomalies(staging.fraud_signals(spark, d))


@query("fraud_score_baselines")
def _(spark, d):
    return kpis.score_baselines(staging.fraud_signals(spark, d))


# --- catalogue of nested queries ------------------------------------------------


def _nested_query(name: str, fn, names: list[str], *values: str) -> None:
    @query(name)
    def _(spark, d):
        return fn(*[lake.nested(spark, d, t) for t in names], *values)


for _name, _fn, _tables, *_values in [
    ("q01_flatten_items", nq.flatten_items, ["transactions"], TX_DT, "US"),
    ("q02_item_color", nq.item_color, ["transactions"], TX_DT, "EU"),
    ("q03_order_value_top5", nq.order_value_top5, ["transactions"], TX_DT, "APAC"),
    ("q04_coords_first10", nq.coords_first10, ["transactions"], TX_DT, "US"),
    ("q05_crypto_payments", nq.payments_by_method, ["transactions"], TX_DT, "EU"),
    ("q06_promo_codes", nq.promo_codes, ["transactions"], TX_DT, "US"),
    ("q07_distinct_colors", nq.distinct_colors, ["transactions"], TX_DT, "APAC"),
    ("q08_user_names", nq.user_names, ["users"], DAY, "DEV"),
    ("q09_emails", nq.emails, ["users"], DAY, "DEV"),
    ("q10_dark_theme", nq.users_with_theme, ["users"], DAY, "DEV"),
    ("q11_users_by_status", nq.users_by_status, ["users"], DAY, "DEV"),
    ("q12_purchases", nq.events_of_type, ["user_events"], DAY, "DEV"),
    ("q13_user_agent", nq.user_agents, ["user_events"], DAY, "PROD"),
    ("q14_events_by_device", nq.events_by_device, ["user_events"], DAY, "DEV"),
    ("q15_events_users", nq.events_with_names, ["user_events", "users"], DAY, "DEV"),
    ("q16_fashion_merchants", nq.merchants_in_category, ["merchants"], TX_DT, "US"),
    ("q17_merchant_categories", nq.merchant_categories, ["merchants"], TX_DT, "EU"),
    ("q18_merchant_contact", nq.merchant_contacts, ["merchants"], TX_DT, "APAC"),
    ("q19_top5_rating", nq.top5_rating, ["merchants"], TX_DT, "US"),
    ("q20_geo_mismatch", nq.signals_with_reason, ["fraud_signals"], DAY, "PROD"),
    ("q21_signals_by_risk", nq.signals_by_risk, ["fraud_signals"], DAY, "DEV"),
    ("q22_high_risk_ip", nq.high_risk_ip, ["fraud_signals"], DAY, "PROD"),
    ("q23_locations", nq.location_coords, ["locations"], DAY, "DEV"),
    ("q24_location_attrs", nq.location_attributes, ["locations"], DAY, "PROD"),
    ("q25_signals_tx", nq.signal_payments, ["fraud_signals", "transactions"], DAY, "DEV", TX_DT,
     "US"),
    ("q26_fraud_value", nq.fraud_value, ["fraud_signals", "transactions"], DAY, "PROD"),
    ("q27_event_profile", nq.event_profile, ["user_events", "users"], DAY, "DEV"),
    ("q28_union_coords", nq.all_coords, ["transactions", "locations"], TX_DT, "US", DAY, "DEV"),
    ("q29_event_row_number", nq.event_row_numbers, ["user_events"], DAY, "PROD"),
    ("q30_missing_promo", nq.missing_promo, ["transactions"], TX_DT, "EU"),
]:
    _nested_query(_name, _fn, _tables, *_values)


# --- partitions -----------------------------------------------------------------


@query("partitions_metadata")
def _(spark, d):
    return catalog.partitions_metadata(spark, lake.registered(spark, d, "transactions"))


@query("latest_partition")
def _(spark, d):
    return catalog.latest_partition(spark, lake.registered(spark, d, "transactions"))


@query("latest_partition_missing_dt")
def _(spark, d):
    """Newest dt where some rows, and one region entirely, have none."""
    orders = nesting.heads(lake.nested(spark, d, "transactions")).select("transaction_id", "dt", "region")
    undated = (F.col("region") == "APAC") | (F.col("transaction_id").cast("long") % 5 == 0)
    loaded = orders.withColumn("dt", F.when(~undated, F.col("dt")))
    name = lake.stored(spark, d, "undated_orders", loaded, ["dt", "region"])
    return catalog.latest_partition(spark, name)


def _scans(spark, d) -> dict[str, DataFrame]:
    orders = spark.table(lake.registered(spark, d, "transactions"))
    return {"full": orders, "pruned": catalog.select_partition(orders, dt=TX_DT, region="EU")}


@query("pruning_ledger")
def _(spark, d):
    """Partitions and rows read with and without the partition filter."""
    ledger = catalog.scan_ledger(_scans(spark, d), ["dt", "region"])
    return ledger.select(
        "scan", "partitions", "rows", (F.col("files") >= F.col("partitions")).alias("a_file_each"),
        (F.col("bytes") > 0).alias("read"),
    )


@query("pruning_by_partition")
def _(spark, d):
    return catalog.partition_ledger(_scans(spark, d), ["dt", "region"]).drop("files")


@query("prune_two_columns")
def _(spark, d):
    name = lake.registered(spark, d, "transactions")
    return spark.sql(
        f"SELECT transaction_id, user_id FROM {name} "
        f"WHERE dt = '{TX_DT}' AND region = 'APAC' AND part_no = 0"
    )


@query("prune_vs_full")
def _(spark, d):
    """One predicate without and with the partition filter."""
    name = lake.registered(spark, d, "transactions")
    card = f"SELECT transaction_id, '{{}}' AS scan FROM {name} "
    card += "WHERE part_no = 0 AND extra_info['payment_method'] = 'CARD'"
    return spark.sql(
        card.format("full")
        + " UNION ALL "
        + card.format("pruned")
        + f" AND dt = '{TX_DT}' AND region = 'US'"
    )


@query("show_partitions")
def _(spark, d):
    return catalog.show_partitions(spark, lake.registered(spark, d, "transactions"))


@query("prune_locations")
def _(spark, d):
    name = lake.registered(spark, d, "locations")
    return spark.sql(
        "SELECT location_id, coords.lat AS lat, coords.lon AS lon "
        f"FROM {name} WHERE dt = '{DAY}' AND environment = 'DEV'"
    )


@query("users_per_day")
def _(spark, d):
    users = spark.table(lake.registered(spark, d, "users"))
    return users.groupBy("dt").agg(F.count("*").alias("total_users")).orderBy("dt")


@query("join_on_partitions")
def _(spark, d):
    tx = nesting.heads(catalog.select_partition(
        spark.table(lake.registered(spark, d, "transactions")), dt=TX_DT, region="US"
    )).select("transaction_id", "merchant_id", "dt", "region")
    sellers = spark.table(lake.registered(spark, d, "merchants")).select(
        "merchant_id", "name", "dt", "region"
    )
    return skew_join(
        tx, catalog.select_partition(sellers, dt=TX_DT, region="US"),
        ["merchant_id", "dt", "region"],
    ).select("transaction_id", "merchant_id", "name")


@query("explain_pruning")
def _(spark, d):
    name = lake.registered(spark, d, "transactions")
    return catalog.explain(
        spark, f"SELECT transaction_id FROM {name} WHERE dt = '{TX_DT}' AND region = 'EU'"
    )
