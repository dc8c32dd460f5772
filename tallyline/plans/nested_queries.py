"""Queries over the nested, partitioned tables.

Each takes the tables it reads and the partition values; the filter on the two
partition columns prunes directories when the table is stored partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.nesting import heads, unnest
from ..operators.skew import number_rows, skew_join
from ..sources.catalog import select_partition


def _desc(column: str, tie: str) -> list[Column]:
    return [F.col(column).desc_nulls_last(), F.col(tie).asc()]


# --- transactions ---


def flatten_items(transactions: DataFrame, dt: str, region: str) -> DataFrame:
    rows = select_partition(transactions, dt=dt, region=region)
    return unnest(rows, "items", "item", ["sku", "price", "quantity"]).select(
        "transaction_id", "item.sku", "item.price", "item.quantity"
    )


def item_color(transactions: DataFrame, dt: str, region: str) -> DataFrame:
    rows = select_partition(transactions, dt=dt, region=region)
    return unnest(rows, "items", "item", ["sku", "price", "attributes"]).select(
        "transaction_id", "item.sku", "item.price",
        F.col("item.attributes")["color"].alias("color_used"),
    )


def order_values(transactions: DataFrame) -> DataFrame:
    """Value of each transaction's items; transactions without items have none."""
    value = F.col("item.price").cast("decimal(18,2)") * F.col("item.quantity")
    return (
        unnest(transactions, "items", "item", ["price", "quantity"])
        .groupBy("transaction_id")
        .agg(F.sum(value).alias("total_order_value"))
    )


def order_value_top5(transactions: DataFrame, dt: str, region: str) -> DataFrame:
    values = order_values(select_partition(transactions, dt=dt, region=region))
    return values.orderBy(*_desc("total_order_value", "transaction_id")).limit(5)


def coords_first10(transactions: DataFrame, dt: str, region: str) -> DataFrame:
    return (
        heads(select_partition(transactions, dt=dt, region=region))
        .select(
            "transaction_id",
            F.col("location_info.country").alias("country_code"),
            F.col("location_info.coords.lat").alias("latitude"),
            F.col("location_info.coords.lon").alias("longitude"),
        )
        .orderBy("transaction_id")
        .limit(10)
    )


def payments_by_method(
    transactions: DataFrame, dt: str, region: str, method: str = "CRYPTO"
) -> DataFrame:
    payment = F.col("extra_info")["payment_method"]
    return (
        heads(select_partition(transactions, dt=dt, region=region))
        .where(payment == method)
        .select("transaction_id", payment.alias("payment_method"))
    )


def promo_codes(transactions: DataFrame, dt: str, region: str) -> DataFrame:
    return heads(select_partition(transactions, dt=dt, region=region)).select(
        "transaction_id", F.col("extra_info")["promo_code"].alias("promo_code")
    )


def colors(transactions: DataFrame) -> DataFrame:
    """Distinct colours over all items that have one."""
    color = F.col("item.attributes")["color"]
    return (
        unnest(transactions, "items", "item", ["attributes"])
        .where(color.isNotNull())
        .select(color.alias("unique_color"))
        .distinct()
    )


def distinct_colors(transactions: DataFrame, dt: str, region: str) -> DataFrame:
    return colors(select_partition(transactions, dt=dt, region=region))


def missing_promo(transactions: DataFrame, dt: str, region: str) -> DataFrame:
    promo = F.col("extra_info")["promo_code"]
    return (
        heads(select_partition(transactions, dt=dt, region=region))
        .where(promo.isNull())
        .select("transaction_id", "extra_info", promo.alias("maybe_promo"))
    )


# --- users and their events ---


def user_names(users: DataFrame, dt: str, environment: str) -> DataFrame:
    return select_partition(users, dt=dt, environment=environment).select(
        "user_id", "name.first_name", "name.last_name"
    )


def emails(users: DataFrame, dt: str, environment: str) -> DataFrame:
    rows = select_partition(users, dt=dt, environment=environment)
    return unnest(rows, "emails", "email").select("user_id", "email")


def users_with_theme(
    users: DataFrame, dt: str, environment: str, theme: str = "dark"
) -> DataFrame:
    selected = F.col("preferences")["theme"]
    return (
        select_partition(users, dt=dt, environment=environment)
        .where(selected == theme)
        .select("user_id", selected.alias("theme_selected"))
    )


def count_by(df: DataFrame, column: str, total: str, name: str | None = None) -> DataFrame:
    """Rows per value of a column or struct field, most frequent first."""
    name = name or column.split(".")[-1]
    return (
        df.groupBy(F.col(column).alias(name))
        .agg(F.count("*").alias(total))
        .orderBy(F.col(total).desc(), F.col(name).asc_nulls_last())
    )


def users_by_status(users: DataFrame, dt: str, environment: str) -> DataFrame:
    rows = select_partition(users, dt=dt, environment=environment)
    return count_by(rows, "status", "total_users")


def events_of_type(
    events: DataFrame, dt: str, environment: str, kind: str = "PURCHASE"
) -> DataFrame:
    return (
        select_partition(events, dt=dt, environment=environment)
        .where(F.col("event_info.type") == kind)
        .select("event_id", "user_id", F.col("event_info.type").alias("event_type"), "event_time")
    )


def user_agents(events: DataFrame, dt: str, environment: str) -> DataFrame:
    return select_partition(events, dt=dt, environment=environment).select(
        "event_id", F.col("event_info.metadata")["user_agent"].alias("user_agent")
    )


def events_by_device(events: DataFrame, dt: str, environment: str) -> DataFrame:
    rows = select_partition(events, dt=dt, environment=environment)
    return count_by(rows, "event_info.device", "total_events", "device_type")


def join_events_users(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events with their user's row of the same day and environment."""
    return skew_join(events, users, ["user_id", "dt", "environment"])


def events_with_names(
    events: DataFrame, users: DataFrame, dt: str, environment: str
) -> DataFrame:
    joined = join_events_users(
        select_partition(events, dt=dt, environment=environment),
        select_partition(users, dt=dt, environment=environment).select(
            "user_id", "dt", "environment", "name"
        ),
    )
    return joined.select(
        "event_id",
        F.col("event_info.type").alias("event_type"),
        F.col("name.first_name").alias("user_first_name"),
        F.col("name.last_name").alias("user_last_name"),
    )


def event_profile(events: DataFrame, users: DataFrame, dt: str, environment: str) -> DataFrame:
    joined = join_events_users(
        select_partition(events, dt=dt, environment=environment),
        select_partition(users, dt=dt, environment=environment).select(
            "user_id", "dt", "environment", "name"
        ),
    )
    return joined.select(
        "event_id", "event_time", "name.first_name", "event_info.device",
        F.col("event_info.metadata")["referrer"].alias("ref_url"),
    )


def number_events(events: DataFrame) -> DataFrame:
    """Number each user's events by time."""
    rows = events.select("user_id", "event_time", "event_id")
    return number_rows(rows, "user_id", ["event_time", "event_id"], "row_num").select(
        "user_id", "event_time", "row_num"
    )


def event_row_numbers(events: DataFrame, dt: str, environment: str) -> DataFrame:
    rows = select_partition(events, dt=dt, environment=environment)
    return number_events(rows).orderBy("user_id", "row_num")


# --- merchants ---


def merchants_in_category(
    merchants: DataFrame, dt: str, region: str, category: str = "Fashion"
) -> DataFrame:
    return (
        select_partition(merchants, dt=dt, region=region)
        .where(F.array_contains("categories", category))
        .select("merchant_id", "name", "categories")
    )


def merchant_categories(merchants: DataFrame, dt: str, region: str) -> DataFrame:
    rows = select_partition(merchants, dt=dt, region=region)
    return unnest(rows, "categories", "category").select("merchant_id", "category")


def merchant_contacts(merchants: DataFrame, dt: str, region: str) -> DataFrame:
    address = F.col("contact.address")
    return select_partition(merchants, dt=dt, region=region).select(
        "merchant_id",
        F.col("contact.phone").alias("phone_number"),
        address["city"].alias("city_in_address"),
        address["postal_code"].alias("zip_code"),
    )


def top_rated(merchants: DataFrame, n: int = 5) -> DataFrame:
    return (
        merchants.select("merchant_id", "name", "rating")
        .orderBy(*_desc("rating", "merchant_id"))
        .limit(n)
    )


def top5_rating(merchants: DataFrame, dt: str, region: str) -> DataFrame:
    return top_rated(select_partition(merchants, dt=dt, region=region))


# --- fraud signals ---


def signals_with_reason(
    signals: DataFrame, dt: str, environment: str, reason: str = "GeoMismatch"
) -> DataFrame:
    return (
        select_partition(signals, dt=dt, environment=environment)
        .where(F.array_contains("reasons", reason))
        .select("signal_id", "transaction_id", "risk_level", "reasons")
    )


def signals_by_risk(signals: DataFrame, dt: str, environment: str) -> DataFrame:
    rows = select_partition(signals, dt=dt, environment=environment)
    return count_by(rows, "risk_level", "total_signals")


def high_risk_ip(signals: DataFrame, dt: str, environment: str) -> DataFrame:
    return (
        select_partition(signals, dt=dt, environment=environment)
        .where(F.col("risk_level") == "HIGH")
        .select("signal_id", F.col("details")["ip_address"].alias("ip_address"))
    )


def signals_with_transactions(signals: DataFrame, transactions: DataFrame) -> DataFrame:
    return skew_join(
        signals.select("signal_id", "risk_level", "transaction_id"), transactions, "transaction_id"
    )


def signal_payments(
    signals: DataFrame, transactions: DataFrame, dt: str, environment: str, tx_dt: str, region: str
) -> DataFrame:
    joined = signals_with_transactions(
        select_partition(signals, dt=dt, environment=environment),
        heads(select_partition(transactions, dt=tx_dt, region=region)).select(
            "transaction_id", "extra_info"
        ),
    )
    return joined.select(
        "signal_id", "risk_level", "transaction_id",
        F.col("extra_info")["payment_method"].alias("pay_method"),
    )


def signal_values(
    signals: DataFrame, transactions: DataFrame, floor: float = 100
) -> DataFrame:
    """Item value of each signalled transaction above a floor.

    The value of a row's items is worked out before the join, so the join moves
    one number per transaction instead of its items.
    """
    money = "decimal(38,2)"
    value = F.aggregate(
        "items",
        F.lit(0).cast(money),
        lambda total, i: (total + i["price"].cast("decimal(18,2)") * i["quantity"]).cast(money),
    )
    valued = transactions.where(F.size("items") > 0).select(
        "transaction_id", value.alias("value")
    )
    return (
        signals_with_transactions(signals, valued)
        .groupBy("signal_id", "risk_level", "transaction_id")
        .agg(F.sum("value").alias("total_value"))
        .where(F.col("total_value") > floor)
        .orderBy(*_desc("total_value", "signal_id"))
    )


def fraud_value(
    signals: DataFrame, transactions: DataFrame, dt: str, environment: str
) -> DataFrame:
    return signal_values(select_partition(signals, dt=dt, environment=environment), transactions)


# --- locations ---


def location_coords(locations: DataFrame, dt: str, environment: str) -> DataFrame:
    return select_partition(locations, dt=dt, environment=environment).select(
        "location_id",
        F.col("name").alias("location_name"),
        F.col("coords.lat").alias("latitude"),
        F.col("coords.lon").alias("longitude"),
    )


def location_attributes(locations: DataFrame, dt: str, environment: str) -> DataFrame:
    attributes = F.col("attributes")
    return select_partition(locations, dt=dt, environment=environment).select(
        "location_id",
        attributes["timezone"].alias("timezone_attr"),
        attributes["local_language"].alias("local_lang"),
    )


def union_coords(transactions: DataFrame, locations: DataFrame) -> DataFrame:
    """All coordinates, tagged with the table they come from."""
    tx = transactions.select(
        "location_info.coords.lat", "location_info.coords.lon",
        F.lit("transactions").alias("source"),
    )
    places = locations.select("coords.lat", "coords.lon", F.lit("locations").alias("source"))
    return tx.unionAll(places)


def all_coords(
    transactions: DataFrame, locations: DataFrame, dt: str, region: str, loc_dt: str,
    environment: str,
) -> DataFrame:
    return union_coords(
        heads(select_partition(transactions, dt=dt, region=region)),
        select_partition(locations, dt=loc_dt, environment=environment),
    )
