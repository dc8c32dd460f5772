"""The given TPC-H-like tables seen as transactions, statements, signals, ...

Times stay TIMESTAMP_NTZ as in the files, so no result depends on a time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F

from .operators.skew import hot_keys, number_rows, skew_join
from .schemas import MONEY
from .session import work_path
from .sources.sinks import write_table
from .sources.tables import test_table

# Fixed values of the fixture.
CURRENCIES = ["USD", "EUR", "GBP", "CAD", "JPY", "AUD"]
POLICY_TYPES = ["KYC", "AML", "REGIONAL_LIMIT", "BLACKLIST"]
CATEGORIES = ["Electronics", "Fashion", "Grocery", "Travel", "Gaming", "Health"]
RISK_LEVELS = ["LOW", "MEDIUM", "HIGH"]
REGIONS = ["US", "EU", "APAC"]
COLORS = ["red", "blue", "green", "black", "white", "silver", "gold"]
DEVICES = ["mobile", "desktop", "tablet", "kiosk"]
REASONS = ["VelocityCheck", "GeoMismatch", "BlacklistedIP", "UnusualAmount"]
POLICY_DETAILS = [
    '{"region": "US_ONLY", "velocity_limit": 1}',
    '{"velocity_limit": 2}',
    '{"region": ',
    '{"region": "EU_ONLY", "velocity_limit": 3}',
    '{"region": null}',
    "",
    '{"region": "GLOBAL", "velocity_limit": 4}',
    "[1]",
    None,
    '{"region": "GLOBAL", "velocity_limit": 5}',
]


def pick(values: list[str], index: Column) -> Column:
    """values[index mod len(values)]"""
    at = F.pmod(index, F.lit(len(values))).cast("int")
    return F.array(*[F.lit(v) for v in values])[at]


def merchant_id(key: Column) -> Column:
    return F.when(
        key.isNotNull(),
        F.concat(F.when(key % 4 == 0, F.lit("MCH-A")).otherwise(F.lit("MCH-")), key.cast("string")),
    )


def user_id(key: Column) -> Column:
    return F.concat(F.lit("USR-"), key.cast("string"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = test_table(spark, sf_dir, "orders")
    seller = (
        test_table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_suppkey").alias("suppkey"))
    )
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    return skew_join(orders, seller, "o_orderkey", "left", unique_right=True).select(
        key.cast("string").alias("transaction_id"),
        user_id(F.col("o_custkey")).alias("user_id"),
        merchant_id(F.col("suppkey")).alias("merchant_id"),
        F.col("o_totalprice").cast(MONEY).alias("amount"),
        pick(CURRENCIES, key).alias("currency"),
        F.when((status == "F") & (F.col("o_orderpriority") == "5-LOW"), "REFUNDED")
        .when(status == "F", "APPROVED")
        .when(status == "O", "PENDING")
        .otherwise("DECLINED")
        .alias("status"),
        F.col("o_orderdate").alias("event_time"),
        F.when(key % 2 == 0, F.concat(F.lit("POL-"), (F.col("o_custkey") % 10).cast("string")))
        .alias("policy_id"),
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    posted = (
        test_table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.sum(F.col("l_extendedprice").cast(MONEY)).cast(MONEY).alias("items_total"),
            F.sum(F.col("l_tax").cast("decimal(6,2)")).cast(MONEY).alias("fee_charged"),
            F.max("l_shipdate").cast("date").alias("posting_date"),
        )
    )
    amounts = test_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast(MONEY).alias("amount")
    )
    key = F.col("o_orderkey")
    prefixes = F.when(key % 50 == 1, F.array(F.lit("S"), F.lit("D"))).otherwise(
        F.array(F.lit("S"))
    )
    return skew_join(amounts, posted, "o_orderkey", "inner", unique_right=True).select(
        F.explode(prefixes).alias("prefix"), "*"
    ).select(
        F.concat("prefix", key.cast("string")).alias("statement_id"),
        F.when(key % 5 == 0, key + 1_000_000_000).otherwise(key).cast("string")
        .alias("transaction_id"),
        "posting_date",
        F.when(key % 3 == 0, F.col("amount")).otherwise(F.col("items_total"))
        .alias("amount_posted"),
        "fee_charged",
    )


def fraud_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return test_table(spark, sf_dir, "events").select(
        event.cast("string").alias("fraud_signal_id"),
        event.cast("string").alias("transaction_id"),
        F.least(F.col("value") / 500, F.lit(1.0)).alias("fraud_score"),
        F.least(F.col("value"), F.lit(100.0)).alias("fraud_score_100"),
        F.concat(F.lit("v"), (event % 3 + 1).cast("string")).alias("model_version"),
        F.col("ts").alias("inference_time"),
        F.concat(F.lit("RULE_"), (event % 3 + 1).cast("string")).alias("reason_code"),
    )


def policies(spark: SparkSession) -> DataFrame:
    """Ten fixed policies; only ever joined to transactions."""
    rows = [
        (
            f"POL-{i}",
            f"Policy {i}",
            POLICY_TYPES[i % 4],
            i % 5 != 4,
            f"2024-01-{i + 1:02d}",
            POLICY_DETAILS[i],
        )
        for i in range(10)
    ]
    return spark.createDataFrame(
        rows,
        "policy_id string, policy_name string, policy_type string, active_flag boolean, "
        "effective_date string, policy_details string",
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return test_table(spark, sf_dir, "supplier").select(
        merchant_id(key).alias("merchant_id"),
        F.col("s_name").alias("merchant_name"),
        pick(CATEGORIES, key).alias("category"),
        pick(RISK_LEVELS, key).alias("risk_level"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(key, F.lit(1500)).cast("int"))
    signup = (
        F.when(key % 97 == 0, F.lit(None).cast("string"))
        .when(key % 89 == 0, "")
        .when(key % 5 == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(key % 5 == 1, F.date_format(day, "MMM dd, yyyy"))
        .when(key % 5 == 2, F.date_format(day, "MMMM d, yyyy"))
        .when(key % 5 == 3, F.date_format(day, "MM/dd/yyyy"))
        .otherwise("some day")
    )
    return test_table(spark, sf_dir, "customer").select(
        user_id(key).alias("user_id"),
        F.col("c_name").alias("user_name"),
        signup.alias("signup_date"),
    )


# --- nested, partitioned tables ------------------------------------------------


def _year_start(ts: Column) -> Column:
    """dt of a table loaded once a year; the given orders span seven years."""
    return F.concat(F.year(ts).cast("string"), F.lit("-01-01"))


def _environment(key: Column) -> Column:
    return F.when(key % 2 == 0, "PROD").otherwise("DEV")


def _coords(key: Column) -> Column:
    return F.struct(
        (key % 180 - 90).cast("double").alias("lat"), (key % 360 - 180).cast("double").alias("lon")
    )


ITEMS_PER_PART = 10_000


def _gathered(rows: DataFrame, *keys: str) -> GroupedData:
    """Rows grouped by `keys` after one shuffle of them as they are, sorted there once.

    Lists gain nothing from a first grouping in the tasks that read: it makes no row
    fewer and sorts them all, in tasks as large as the files say.
    """
    return rows.repartition(*keys).sortWithinPartitions(*keys).groupBy(*keys)


def _item_parts(lines: DataFrame, part_items: int) -> DataFrame:
    """o_orderkey, part_no, suppkey, items: no array longer than `part_items`.

    An order of up to so many lines is part 0. Of a larger one part 0 is empty, and its
    lines are dealt over parts 1, 2, ... by number, so no task sees all of them.
    """
    spark = lines.sparkSession
    # A missing key has no order, however many lines it has.
    lines = lines.where(F.col("l_orderkey").isNotNull()).withColumnRenamed("l_orderkey", "o_orderkey")
    path = work_path(spark, "large_orders")
    # Counted in the tasks that read the lines; at most a row for each `part_items` lines.
    write_table(
        lines.groupBy("o_orderkey").agg(F.count("*").alias("_lines"))
        .where(F.col("_lines") > part_items),
        path,
    )
    large = spark.read.parquet(path)
    if large.isEmpty():
        return (
            _gathered(lines, "o_orderkey")
            .agg(F.min("l_suppkey").alias("suppkey"), F.collect_list("item").alias("items"))
            .withColumn("part_no", F.lit(0))
        )

    path = work_path(spark, "large_orders")
    write_table(
        lines.join(large, "o_orderkey").groupBy("o_orderkey", "_lines")
        .agg(F.min("l_suppkey").alias("_suppkey")),
        path,
    )
    large = spark.read.parquet(path)
    # Half full on average: a slice is hardly ever too large, and is cut if it is.
    slices = F.ceil(F.lit(2) * F.col("_lines") / part_items)
    number = F.xxhash64(F.monotonically_increasing_id())
    dealt = (
        lines.withColumn("_number", number)
        .join(large, "o_orderkey", "left")
        .withColumn("_slices", slices)
        .withColumn("_slice", F.when(F.col("_lines").isNotNull(), 1 + F.pmod("_number", "_slices")).otherwise(0))
    )
    sliced = _gathered(dealt.drop("_number"), "o_orderkey", "_slice").agg(
        F.coalesce(F.max("_suppkey"), F.min("l_suppkey")).alias("suppkey"),
        F.max("_slices").alias("_slices"), F.collect_list("item").alias("_all"),
    )
    pieces = F.transform(
        F.sequence(F.lit(0), F.expr(f"int((size(_all) - 1) div {part_items})")),
        lambda i: F.slice(F.col("_all"), i * part_items + 1, F.lit(part_items)),
    )
    parts = sliced.select(
        "o_orderkey", "suppkey", "_slice", "_slices", F.posexplode(pieces).alias("_piece", "items")
    ).select(
        "o_orderkey", "suppkey", "items",
        (F.col("_slice") + F.coalesce("_slices", F.lit(0)) * F.col("_piece")).cast("int").alias("part_no"),
    )
    empty = F.array().cast(parts.schema["items"].dataType)
    heads = large.select(
        "o_orderkey", F.col("_suppkey").alias("suppkey"), empty.alias("items"), F.lit(0).alias("part_no")
    )
    return parts.unionByName(heads)


def order_rows(
    spark: SparkSession, sf_dir: str, part_items: int = ITEMS_PER_PART
) -> DataFrame:
    """What `as_transactions` makes nested transactions of: numbers and items, no maps.

    These rows are what is shuffled; the maps and texts of an item take several times
    as much, and are made by the tasks that write them.
    """
    item = F.struct(
        F.col("l_partkey").alias("part"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.coalesce(F.col("l_linenumber") != 1, F.lit(False)).alias("colored"),
    )
    lines = test_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", item.alias("item"))
    orders = test_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.join(_item_parts(lines, part_items), "o_orderkey", "left").select(
        "o_orderkey", "o_custkey", "o_orderdate", "suppkey", "items",
        F.coalesce("part_no", F.lit(0)).alias("part_no"),
        _year_start(F.col("o_orderdate")).alias("dt"),
        pick(REGIONS, F.col("o_custkey")).alias("region"),
    )


def as_transactions(rows: DataFrame) -> DataFrame:
    """Rows of `order_rows` as nested transactions."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")

    def item(i: Column) -> Column:
        size = F.create_map(F.lit("size"), F.lit("M"))
        both = F.create_map(F.lit("size"), F.lit("M"), F.lit("color"), pick(COLORS, i["part"]))
        return F.struct(
            i["part"].cast("string").alias("sku"),
            i["price"].alias("price"),
            i["quantity"].alias("quantity"),
            F.when(i["colored"], both).otherwise(size).alias("attributes"),
        )

    extra = F.create_map(
        F.lit("payment_method"), pick(["CARD", "PAYPAL", "CRYPTO"], key)
    )
    promo = F.create_map(
        F.lit("promo_code"), F.concat(F.lit("PROMO"), (key % 100).cast("string"))
    )
    return rows.select(
        key.cast("string").alias("transaction_id"),
        user_id(cust).alias("user_id"),
        merchant_id(F.col("suppkey")).alias("merchant_id"),
        F.transform("items", item).alias("items"),
        F.col("o_orderdate").cast("timestamp").alias("transaction_time"),
        F.struct(
            F.col("region").alias("country"),
            F.concat(F.lit("City-"), (cust % 50).cast("string")).alias("city"),
            _coords(cust).alias("coords"),
        ).alias("location_info"),
        F.when(key % 4 == 0, F.map_concat(extra, promo)).otherwise(extra).alias("extra_info"),
        "part_no",
        "dt",
        "region",
    )


def nested_transactions(
    spark: SparkSession, sf_dir: str, part_items: int = ITEMS_PER_PART
) -> DataFrame:
    """Orders with their items, in parts of at most `part_items`.

    Every order has one row with part_no 0; only orders with more items have others,
    with the same ids and times. Readers of items put parts together by transaction_id,
    readers of anything else take part 0 (`heads`).
    """
    return as_transactions(order_rows(spark, sf_dir, part_items))


def nested_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    address = F.concat(F.lit("u"), key.cast("string"), F.lit("@example.com"))
    second = F.concat(F.lit("u"), key.cast("string"), F.lit("@example.org"))
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(key, F.lit(30)).cast("int"))
    return test_table(spark, sf_dir, "customer").select(
        user_id(key).alias("user_id"),
        F.struct(
            F.split("c_name", "#")[0].alias("first_name"),
            F.split("c_name", "#")[1].alias("last_name"),
        ).alias("name"),
        F.when(key % 3 == 0, F.array(address, second)).otherwise(F.array(address)).alias("emails"),
        F.create_map(
            F.lit("theme"), F.when(key % 4 < 2, "dark").otherwise("light"),
            F.lit("language"), F.lit("en"),
        ).alias("preferences"),
        day.cast("timestamp").alias("sign_up_timestamp"),
        F.when(F.col("c_mktsegment").isin("MACHINERY", "BUILDING"), "ACTIVE")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "SUSPENDED")
        .otherwise("PENDING")
        .alias("status"),
        day.cast("string").alias("dt"),
        _environment(key).alias("environment"),
    )


def nested_user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    kind = (
        F.when(F.col("event_type") == "signup", "LOGIN")
        .when(F.col("event_type") == "purchase", "PURCHASE")
        .when(F.col("event_type") == "error", "LOGOUT")
        .otherwise("BROWSE")
    )
    agent = F.concat(F.lit("agent/"), F.get_json_object("props", "$.k"))
    referrer = F.concat(F.lit("https://ref.example/"), (event % 7).cast("string"))
    metadata = F.create_map(F.lit("user_agent"), agent)
    return test_table(spark, sf_dir, "events").select(
        event.cast("string").alias("event_id"),
        user_id(F.col("user_id")).alias("user_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.struct(
            kind.alias("type"),
            pick(DEVICES, event).alias("device"),
            F.concat(F.lit("City-"), (event % 50).cast("string")).alias("location"),
            F.when(
                event % 3 != 0, F.map_concat(metadata, F.create_map(F.lit("referrer"), referrer))
            ).otherwise(metadata).alias("metadata"),
        ).alias("event_info"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        _environment(F.col("user_id")).alias("environment"),
    )


def nested_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    text = key.cast("string")
    categories = F.when(
        key % 10 == 9, F.array().cast("array<string>")
    ).otherwise(F.array(pick(CATEGORIES, key), pick(CATEGORIES, key + 1)))
    return test_table(spark, sf_dir, "supplier").select(
        merchant_id(key).alias("merchant_id"),
        F.col("s_name").alias("name"),
        categories.alias("categories"),
        F.struct(
            F.concat(F.lit("+1-555-"), text).alias("phone"),
            F.concat(F.lit("m"), text, F.lit("@example.com")).alias("email"),
            F.create_map(
                F.lit("city"), F.concat(F.lit("City-"), F.col("s_nationkey").cast("string")),
                F.lit("postal_code"), F.lpad((key % 100000).cast("string"), 5, "0"),
            ).alias("address"),
        ).alias("contact"),
        (F.floor(F.col("s_acctbal") / 2500) + 1).cast("double").alias("rating"),
        F.concat((key % 7 + 1995).cast("string"), F.lit("-01-01")).alias("dt"),
        pick(REGIONS, F.floor(key / 7)).alias("region"),
    )


def nested_fraud_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    score = F.least(F.col("value"), F.lit(100.0))
    return test_table(spark, sf_dir, "events").select(
        event.cast("string").alias("signal_id"),
        event.cast("string").alias("transaction_id"),
        F.col("ts").cast("timestamp").alias("signal_time"),
        F.when(score >= 90, "HIGH").when(score >= 70, "MEDIUM").otherwise("LOW")
        .alias("risk_level"),
        F.when(event % 5 == 0, F.array(pick(REASONS, event), pick(REASONS, event + 1)))
        .otherwise(F.array(pick(REASONS, event)))
        .alias("reasons"),
        F.create_map(
            F.lit("ip_address"),
            F.concat(
                F.lit("10.0."), (event % 256).cast("string"), F.lit("."),
                (F.col("user_id") % 256).cast("string"),
            ),
            F.lit("model"), F.concat(F.lit("v"), (event % 3 + 1).cast("string")),
        ).alias("details"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        _environment(F.col("user_id")).alias("environment"),
    )


def nested_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery location per customer."""
    key = F.col("c_custkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(key, F.lit(3)).cast("int"))
    zone = F.create_map(
        F.lit("timezone"), F.concat(F.lit("UTC+"), (F.col("c_nationkey") % 12).cast("string"))
    )
    language = F.create_map(
        F.lit("local_language"), pick(["en", "de", "fr", "ja"], F.col("c_nationkey"))
    )
    return test_table(spark, sf_dir, "customer").select(
        F.concat(F.lit("LOC-"), key.cast("string")).alias("location_id"),
        pick(REGIONS, key).alias("region"),
        F.concat(F.lit("Place "), key.cast("string")).alias("name"),
        _coords(key).alias("coords"),
        F.when(key % 4 != 3, F.map_concat(zone, language)).otherwise(zone).alias("attributes"),
        day.cast("string").alias("dt"),
        _environment(F.floor(key / 3)).alias("environment"),
    )


NESTED_VIEWS = {
    "transactions": nested_transactions,
    "users": nested_users,
    "user_events": nested_user_events,
    "merchants": nested_merchants,
    "fraud_signals": nested_fraud_signals,
    "locations": nested_locations,
}

# Views that are shuffled as other rows before they are stored, and what those become.
NARROW_VIEWS = {"transactions": (order_rows, as_transactions)}
