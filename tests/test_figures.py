"""Runs, quantiles, baselines and scan ledgers against plain Python."""

import datetime as dt
import random
from collections import Counter, defaultdict
from itertools import groupby

import pytest
from conftest import bag, formatted_plan
from pyspark.sql import functions as F

from tallyline import staging
from tallyline.operators import kpis, nesting, quantiles, runs
from tallyline.plans import nested_queries as nq
from tallyline.session import work_path
from tallyline.sources import catalog

START = dt.datetime(2024, 1, 1)


# --- runs -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def payments(spark):
    """One user holds a third of all rows; times tie; some rows lack a time or a user."""
    rng = random.Random(1)
    rows = []
    for i in range(1800):
        user = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", "d", None])
        time = START + dt.timedelta(hours=rng.randrange(24 * 12))
        status = "DECLINED" if rng.random() < 0.7 else "APPROVED"
        rows.append((f"t{i:04d}", user, None if i % 97 == 0 else time, status, rng.randrange(-500, 10_000)))
    rows += [("x1", "never", START, "APPROVED", 1), ("x2", "always", START, "DECLINED", None)]
    return spark.createDataFrame(
        rows, "transaction_id string, user_id string, event_time timestamp_ntz, status string, cents long"
    )


def brute_runs(rows):
    users = defaultdict(list)
    for r in rows:
        users[r.user_id]
        if r.event_time is not None:
            users[r.user_id].append((r.event_time, r.transaction_id, r.status == "DECLINED"))
    out = {}
    for user, own in users.items():
        found = [
            (-len(run), run[0][0], run[-1][0])
            for declined, group in groupby(sorted(own), key=lambda x: x[2]) if declined
            for run in [list(group)]
        ]
        less, begin, end = min(found, default=(0, None, None))
        out[user] = (sum(x[2] for x in own), -less, begin, end)
    return out


@pytest.mark.parametrize("unit", ["hour", "day", "week", "year"])
def test_longest_runs_do_not_depend_on_the_slices(payments, unit):
    got = {r[0]: tuple(r)[1:] for r in runs.decline_runs(payments, unit).collect()}
    assert got == brute_runs(payments.collect())


def test_no_task_needs_all_rows_of_a_hot_user(payments):
    plan = formatted_plan(runs.decline_runs(payments, "day"))
    sliced = payments.where("user_id = 'hot'").groupBy(F.date_trunc("day", "event_time")).count()
    assert sliced.agg(F.max("count")).first()[0] < payments.count() / 20
    assert "hashpartitioning(user_id" in plan and "slice" in plan


def test_stored_summaries_take_new_slices(payments):
    keys = ["user_id"]

    def parts(df):
        return runs.slice_summaries(df, keys, "event_time", ["transaction_id"], F.col("status") == "DECLINED")

    noon = F.lit(START + dt.timedelta(days=5)).cast("timestamp_ntz")
    old, new = payments.where(F.col("event_time") < noon), payments.where(F.col("event_time") >= noon)
    together = runs.longest_runs(parts(old).unionByName(parts(new)), keys)
    assert bag(together) == bag(runs.longest_runs(parts(payments), keys))


# --- quantiles ------------------------------------------------------------------


def brute_quantile(values, q):
    values = sorted(values)
    place = (len(values) - 1) * q
    low, high = values[int(place)], values[min(int(place) + (place > int(place)), len(values) - 1)]
    return low + (high - low) * (place - int(place))


def test_exact_quantiles(payments):
    wanted = {"low": 0.0, "median": 0.5, "p95": 0.95, "high": 1.0}
    got = quantiles.exact_quantiles(payments, ["user_id"], F.col("cents"), wanted).collect()
    groups = defaultdict(list)
    for r in payments.collect():
        if r.cents is not None:
            groups[r.user_id].append(r.cents)
    assert {r.user_id for r in got} == set(groups) and "always" not in groups
    for r in got:
        assert r["values"] == len(groups[r.user_id])
        for name, q in wanted.items():
            assert r[name] == pytest.approx(brute_quantile(groups[r.user_id], q))


def test_buckets_keep_the_order(spark):
    rng = random.Random(2)
    values = sorted({rng.randrange(-(1 << b), 1 << b) for b in range(1, 62) for _ in range(30)} | {0, 63, 64, 65})
    df = spark.createDataFrame([(v,) for v in values], "v long")
    found = [r.b for r in df.select("v", quantiles.value_bucket(F.col("v")).alias("b")).orderBy("v").collect()]
    assert found == sorted(found) and len(set(found)) < 4200


def test_no_list_of_values_is_built(payments):
    plan = formatted_plan(quantiles.exact_quantiles(payments, ["user_id"], F.col("cents"), {"m": 0.5}))
    assert "collect_list" not in plan and "percentile" not in plan


def test_rolled_up_sketches_are_close(spark):
    events = spark.range(300_000).select(
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id") % 7200)).alias("t"),
        (F.pow(F.rand(3), 4) * 1000).alias("ms"),
    )
    path = work_path(spark, "events")
    events.write.parquet(path)
    events = spark.read.parquet(path)
    small = quantiles.window_sketches(events, "t", F.col("ms"))
    hourly = quantiles.tails(quantiles.roll_up(small))
    errors = quantiles.rank_errors(events, "t", F.col("ms"), hourly).collect()
    assert len(errors) == 2 and sum(r["values"] for r in errors) == 300_000
    assert all(r[f"{n}_error"] < 0.01 for r in errors for n in quantiles.TAILS)


def test_sketches_of_a_stream(spark):
    path = work_path(spark, "stream")
    rows = [(START + dt.timedelta(minutes=i % 20), float(i)) for i in range(200)]
    rows.append((START + dt.timedelta(days=1), 0.0))
    spark.createDataFrame(rows, "t timestamp, ms double").write.json(path)
    stream = spark.readStream.schema("t timestamp, ms double").json(path).withWatermark("t", "1 hour")
    sketches = quantiles.window_sketches(stream, "t", F.col("ms"))
    out = work_path(spark, "sketches")
    run = (
        sketches.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", work_path(spark, "ckpt")).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.count() == 4
    found = quantiles.tails(quantiles.roll_up(stored)).first()
    assert found["values"] == 200 and abs(found.p50 - 100) <= 2 and found.p99 >= 195


# --- baselines ------------------------------------------------------------------


def test_baseline_counts_clock_hours(spark):
    hours = [0, 1, 2, 5, 6, 30]
    rows = [("m", START + dt.timedelta(hours=h, minutes=k), 0.25 * (k + 1)) for h in hours for k in range(h % 3 + 1)]
    signals = spark.createDataFrame(rows, "model_version string, inference_time timestamp_ntz, fraud_score double")
    got = {r.hour: r for r in kpis.score_baselines(signals, hours=4).collect()}
    per_hour = Counter(r[1].replace(minute=0) for r in rows)
    assert sorted(got) == [START + dt.timedelta(hours=h) for h in range(4, 31)]
    for hour, r in got.items():
        before = [per_hour[hour - dt.timedelta(hours=k)] for k in range(1, 5)]
        assert (r.signals, r.usual_signals) == (per_hour[hour], sum(before) / 4)
        assert (r.baseline is None) == (sum(before) == 0)
        assert (r.mean_score is None) == (r.signals == 0)


# --- partitions -----------------------------------------------------------------


@pytest.fixture(scope="module")
def stored(spark):
    rows = [(i, d, r) for i, (d, r) in enumerate(
        [("2024-01-01", "a b"), ("2024-01-02", "a b"), (None, "a b"), (None, "a=b/c+%"), ("_x", None)] * 3
    )]
    df = spark.createDataFrame(rows, "id long, dt string, region string")
    path = work_path(spark, "stored")
    df.repartition(1).write.partitionBy("dt", "region").parquet(path)
    return catalog.register_stored(spark, path, "tallyline_figures.stored", df.schema, ["dt", "region"])


def test_missing_partition_values_are_null(spark, stored):
    found = {tuple(r) for r in catalog.partitions_metadata(spark, stored).collect()}
    assert found == {
        ("2024-01-01", "a b"), ("2024-01-02", "a b"), (None, "a b"), (None, "a=b/c+%"), ("_x", None)
    }
    newest = {r.region: r.latest_dt for r in catalog.latest_partition(spark, stored).collect()}
    assert newest == {"a b": "2024-01-02", "a=b/c+%": None, None: "_x"}


def test_any_number_of_partition_columns(spark):
    df = spark.createDataFrame([(1, "x")], "id long, day string")
    path = work_path(spark, "one")
    df.write.partitionBy("day").parquet(path)
    name = catalog.register_stored(spark, path, "tallyline_one.stored", df.schema, ["day"])
    assert [tuple(r) for r in catalog.partitions_metadata(spark, name).collect()] == [("x",)]


def test_ledger_counts_what_scans_read(spark, stored):
    table = spark.table(stored)
    scans = {"full": table, "pruned": table.where("dt = '2024-01-02'"), "none": table.where("dt = '1999'")}
    rows = {r.scan: r for r in catalog.scan_ledger(scans, ["dt", "region"]).collect()}
    assert [(r.partitions, r.files, r.rows) for r in (rows["full"], rows["pruned"], rows["none"])] == [
        (5, 5, 15), (1, 1, 3), (0, 0, 0)
    ]
    assert rows["pruned"].bytes < rows["full"].bytes
    parts = catalog.partition_ledger(scans, ["dt", "region"]).where("scan = 'full'").collect()
    assert {(r.dt, r.region): (r.files, r.rows) for r in parts}[None, "a b"] == (1, 3)


# --- orders in parts ------------------------------------------------------------


def _flat(spark, path, lines=900):
    """An order with a third of the lines, others of up to seven, one without any."""
    spark.range(lines).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1L ELSE 2 + id % 200 END AS l_orderkey",
        "id % 50 AS l_partkey", "100 - id % 40 AS l_suppkey", "CAST(1 + id % 7 AS INT) AS l_linenumber",
        "CAST(1 + id % 5 AS DOUBLE) AS l_quantity", "CAST(id % 90 AS DOUBLE) + 0.5D AS l_extendedprice",
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.sql(
        "SELECT id + 1 AS o_orderkey, id % 9 AS o_custkey, "
        "timestamp_ntz '1996-05-05 00:00:00' AS o_orderdate FROM range(202)"
    ).write.parquet(f"{path}/orders.parquet")


@pytest.fixture(scope="module")
def orders_in_parts(spark):
    path = work_path(spark, "flat")
    _flat(spark, path)
    return {n: staging.nested_transactions(spark, path, n).cache() for n in (2, 100, 1000)}


@pytest.mark.parametrize("size", [2, 100, 1000])
def test_no_array_is_longer_than_a_part(orders_in_parts, size):
    rows = orders_in_parts[size].select("transaction_id", "part_no", F.size("items").alias("n")).collect()
    assert max(r.n or 0 for r in rows) <= size
    assert Counter(r.transaction_id for r in rows if r.part_no == 0) == Counter(str(i + 1) for i in range(202))
    assert len({(r.transaction_id, r.part_no) for r in rows}) == len(rows)
    assert sum(r.n or 0 for r in rows) == 900


def test_answers_do_not_depend_on_the_parts(spark, orders_in_parts):
    signals = spark.createDataFrame(
        [(f"s{i}", str(1 + i % 9), "HIGH", "d", "e") for i in range(20)],
        "signal_id string, transaction_id string, risk_level string, dt string, environment string",
    )
    where = ("1996-01-01", "US")
    queries = [
        lambda t: nq.flatten_items(t, *where), lambda t: nq.item_color(t, *where),
        lambda t: nq.order_value_top5(t, *where), lambda t: nq.coords_first10(t, *where),
        lambda t: nq.payments_by_method(t, *where, "PAYPAL"), lambda t: nq.promo_codes(t, *where),
        lambda t: nq.distinct_colors(t, *where), lambda t: nq.missing_promo(t, *where),
        lambda t: nq.signal_payments(signals, t, "d", "e", *where),
        lambda t: nq.fraud_value(signals, t, "d", "e"),
        lambda t: nesting.heads(t).select("transaction_id", "merchant_id"),
    ]
    for number, run in enumerate(queries):
        answers = [bag(run(t)) for t in orders_in_parts.values()]
        assert answers[0] == answers[1] == answers[2] and answers[0], number
