"""Column rules for labels, masks, amounts, dates and statuses.

Each takes columns and returns a column built from Spark's own expressions, so
filters still reach the scan and the stage stays compiled.

Rounding: money is decimal and rounds half up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY

# Score limits on the 0-100 scale.
HIGH_SCORE = 90
MEDIUM_SCORE = 70
# Fixed value: score limit on the 0-1 scale.
FRAUD_THRESHOLD = 0.8
# Exchange rates to USD.
USD_RATES = {
    "USD": "1.0",
    "EUR": "1.07",
    "GBP": "1.24",
    "CAD": "0.80",
    "JPY": "0.0075",
}
# Accepted date layouts, tried in this order.
DATE_LAYOUTS = ["yyyy-M-d", "MMM d, yyyy", "MMMM d, yyyy", "M/d/yyyy"]


def _filled(text: Column) -> Column:
    """Null for empty text."""
    return F.nullif(text, F.lit(""))


def score_label(score: Column) -> Column:
    """Risk label of a 0-100 score. NaN compares with nothing and is LOW."""
    score = F.nanvl(score.cast("double"), F.lit(0.0))
    return (
        F.when(score.isNull(), "UNKNOWN")
        .when(score >= HIGH_SCORE, "HIGH")
        .when(score >= MEDIUM_SCORE, "MEDIUM")
        .otherwise("LOW")
    )


def masked_name(name: Column) -> Column:
    """First character, then one star per further character."""
    return F.concat(F.left(name, F.lit(1)), F.repeat(F.lit("*"), F.length(name) - 1))


def masked_id(value: Column) -> Column:
    """First two characters, then stars; nothing for a missing id."""
    kept = F.concat(F.left(value, F.lit(2)), F.repeat(F.lit("*"), F.length(value) - 2))
    return F.coalesce(kept, F.lit(""))


def policy_region(details: Column) -> Column:
    """Region named in a policy's JSON text.

    UNKNOWN without text or without the key, INVALID_JSON when the text is no
    JSON object, null when the key holds a JSON null.
    """
    parsed = F.try_parse_json(details)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    has_key = F.array_contains(F.json_object_keys(details), "region")
    return (
        F.when(_filled(details).isNull(), "UNKNOWN")
        .when(~is_object, "INVALID_JSON")
        .when(has_key, F.get_json_object(details, "$.region"))
        .otherwise("UNKNOWN")
    )


def amount_in_usd(amount: Column, currency: Column) -> Column:
    """Amount times its currency's rate, to the cent.

    0 for a missing amount; unchanged for a currency without a rate.
    """
    rate = F.create_map(
        *[F.lit(x) if i == 0 else F.lit(x).cast("decimal(10,4)")
          for pair in USD_RATES.items() for i, x in enumerate(pair)]
    )[F.coalesce(currency, F.lit(""))]
    converted = F.round(amount * rate, 2).cast(MONEY)
    return F.coalesce(converted, amount.cast(MONEY), F.lit(0).cast(MONEY))


def rounded_amount(amount: Column) -> Column:
    """To the cent; 0 for a missing amount."""
    return F.coalesce(F.round(amount, 2), F.lit(0)).cast(MONEY)


def iso_date(text: Column) -> Column:
    """Date text in any known layout as yyyy-MM-dd."""
    parsed = F.coalesce(*[F.try_to_date(text, layout) for layout in DATE_LAYOUTS])
    return F.when(_filled(text).isNull(), "UNKNOWN").otherwise(
        F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit("INVALID_DATE"))
    )


def discrepancy(amount: Column, posted: Column) -> Column:
    """Posted minus expected; 0 when either is missing."""
    return F.coalesce(F.round(posted.cast(MONEY) - amount.cast(MONEY), 2), F.lit(0)).cast(MONEY)


def risk_label(score: Column, flags: Column) -> Column:
    """Compliance label from a 0-1 score and the policy flags text. NaN is no risk."""
    found = F.upper(F.coalesce(flags, F.lit("")))
    risky = F.coalesce(F.nanvl(score.cast("double"), F.lit(0.0)), F.lit(0.0)) > FRAUD_THRESHOLD
    return (
        F.when(risky | F.contains(found, F.lit("BLACKLIST")), "HIGH_RISK")
        .when(F.contains(found, F.lit("KYC")), "REQUIRES_KYC")
        .otherwise("OK")
    )


def final_status(current: Column, bank: Column) -> Column:
    """Status after hearing from the bank; empty text counts as missing."""
    current, bank = _filled(current), _filled(bank)
    return (
        F.when(bank.isNull(), F.coalesce(current, F.lit("UNKNOWN")))
        .when(F.upper(bank) == "MATCHED", F.coalesce(current, F.lit("MATCHED")))
        .when(F.upper(bank) == "UNMATCHED", "DISCREPANCY")
        .otherwise(F.coalesce(current, bank))
    )


def match_status(statement_id: Column) -> Column:
    return F.when(statement_id.isNull(), "UNMATCHED").otherwise("MATCHED")


def merchant_kpi(merchant: Column, daily_value: Column) -> Column:
    """Daily value, ten percent up for merchants of the MCH-A group."""
    value = F.coalesce(daily_value, F.lit(0))
    factor = F.when(F.startswith(merchant, F.lit("MCH-A")), F.lit("1.1").cast("decimal(2,1)"))
    factor = factor.otherwise(F.lit("1.0").cast("decimal(2,1)"))
    return F.round(value * factor, 2).cast(MONEY)
