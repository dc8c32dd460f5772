"""Edge rows of every column rule."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline.functions import columns as C
from tallyline.operators import enrichment


def apply(spark, schema, rows, rule):
    """Results of a rule over rows, in order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(rule).collect()]


def test_score_label(spark):
    rows = [(None,), (0.0,), (69.99,), (70.0,), (89.99,), (90.0,), (100.0,)]
    assert apply(spark, "s double", rows, C.score_label(F.col("s"))) == [
        "UNKNOWN", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH",
    ]


def test_masked_name(spark):
    rows = [(None,), ("",), ("A",), ("Al",), ("Al Smith",)]
    assert apply(spark, "n string", rows, C.masked_name(F.col("n"))) == [
        None, "", "A", "A*", "A*******",
    ]


def test_masked_id(spark):
    rows = [(None,), ("",), ("U",), ("US",), ("USR-1234",)]
    assert apply(spark, "n string", rows, C.masked_id(F.col("n"))) == [
        "", "", "U", "US", "US******",
    ]


def test_policy_region(spark):
    rows = [
        (None,), ("",), ('{"region":"EU"}',), ("{}",), ('{"region":null}',), ("[1]",), ("{bad",),
        ('"text"',), ("null",), ('{"other":{"region":"EU"}}',), ('{"region":5}',),
        (' {"velocity_limit": 3, "region": "US_ONLY"} ',),
    ]
    assert apply(spark, "p string", rows, C.policy_region(F.col("p"))) == [
        "UNKNOWN", "UNKNOWN", "EU", "UNKNOWN", None, "INVALID_JSON", "INVALID_JSON",
        "INVALID_JSON", "INVALID_JSON", "UNKNOWN", "5", "US_ONLY",
    ]


def test_amount_in_usd(spark):
    ten = Decimal("10.00")
    rows = [
        (None, "EUR"), (ten, None), (ten, "CHF"), (ten, "USD"), (ten, "EUR"), (ten, "GBP"),
        (ten, "CAD"), (ten, "JPY"), (Decimal("33.33"), "EUR"),
    ]
    got = apply(
        spark, "a decimal(18,2), c string", rows, C.amount_in_usd(F.col("a"), F.col("c"))
    )
    want = ["0", "10", "10", "10", "10.70", "12.40", "8", "0.08", "35.66"]
    assert got == [Decimal(x) for x in want]


def test_rounded_amount(spark):
    rows = [(None,), (Decimal("2.675"),), (Decimal("-0.125"),), (Decimal("1.000"),)]
    assert apply(spark, "a decimal(18,3)", rows, C.rounded_amount(F.col("a"))) == [
        Decimal("0.00"), Decimal("2.68"), Decimal("-0.13"), Decimal("1.00"),
    ]


@pytest.mark.parametrize(
    "text, date",
    [
        (None, "UNKNOWN"),
        ("", "UNKNOWN"),
        ("2025-01-15", "2025-01-15"),
        ("2025-1-5", "2025-01-05"),
        ("Jan 15, 2025", "2025-01-15"),
        ("January 15, 2025", "2025-01-15"),
        ("01/15/2025", "2025-01-15"),
        ("2025-02-30", "INVALID_DATE"),
        ("15/01/2025", "INVALID_DATE"),
        ("garbage", "INVALID_DATE"),
    ],
)
def test_iso_date(spark, text, date):
    assert apply(spark, "d string", [(text,)], C.iso_date(F.col("d"))) == [date]


def test_discrepancy(spark):
    rows = [(None, 5.0), (5.0, None), (5.0, 5.0), (66.85, 66.8), (1.0, 3.5)]
    got = apply(spark, "a double, p double", rows, C.discrepancy(F.col("a"), F.col("p")))
    assert got == [Decimal(x) for x in ["0", "0", "0", "-0.05", "2.5"]]


def test_risk_label(spark):
    rows = [
        (None, None), (0.8, None), (0.81, None), (0.1, "kyc"), (0.1, "blacklist"),
        (None, "KYC,BLACKLIST"), (0.9, "KYC"), (None, "AML"), (0.0, ""),
    ]
    got = apply(spark, "s double, f string", rows, C.risk_label(F.col("s"), F.col("f")))
    assert got == [
        "OK", "OK", "HIGH_RISK", "REQUIRES_KYC", "HIGH_RISK", "HIGH_RISK", "HIGH_RISK", "OK", "OK",
    ]


@pytest.mark.parametrize(
    "bank, current, final",
    [
        (None, None, "UNKNOWN"),
        ("", "", "UNKNOWN"),
        (None, "APPROVED", "APPROVED"),
        ("matched", None, "MATCHED"),
        ("matched", "", "MATCHED"),
        ("MATCHED", "REFUNDED", "REFUNDED"),
        ("Unmatched", "APPROVED", "DISCREPANCY"),
        ("UNMATCHED", None, "DISCREPANCY"),
        ("OTHER", None, "OTHER"),
        ("OTHER", "APPROVED", "APPROVED"),
    ],
)
def test_final_status(spark, bank, current, final):
    rule = C.final_status(F.col("c"), F.col("b"))
    assert apply(spark, "c string, b string", [(current, bank)], rule) == [final]


def test_match_status(spark):
    assert apply(spark, "s string", [(None,), ("S1",)], C.match_status(F.col("s"))) == [
        "UNMATCHED", "MATCHED",
    ]


def test_merchant_kpi(spark):
    hundred = Decimal("100.05")
    rows = [(None, hundred), ("MCH-A1", hundred), ("MCH-1", hundred), ("MCH-A1", None)]
    rule = C.merchant_kpi(F.col("m"), F.col("v"))
    assert apply(spark, "m string, v decimal(18,2)", rows, rule) == [
        Decimal("100.05"), Decimal("110.06"), Decimal("100.05"), Decimal("0.00"),
    ]


def test_daily_kpi_sums_before_the_factor(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('MCH-A1', 10.00, timestamp '2025-01-01 10:00:00'),
           ('MCH-A1', 5.00, timestamp '2025-01-01 23:00:00'),
           ('MCH-A1', 1.00, timestamp '2025-01-02 00:00:00') AS t(merchant_id, amount, event_time)"""
    )
    got = {str(r.day): r.kpi for r in enrichment.daily_merchant_kpi(df).collect()}
    assert got == {"2025-01-01": Decimal("16.50"), "2025-01-02": Decimal("1.10")}


def test_nan_scores_are_low(spark):
    from tallyline.functions import columns as C

    row = spark.range(1).select(
        C.score_label(F.lit(float("nan"))).alias("a"),
        C.risk_label(F.lit(float("nan")), F.lit(None).cast("string")).alias("b"),
    ).first()
    assert (row.a, row.b) == ("LOW", "OK")
