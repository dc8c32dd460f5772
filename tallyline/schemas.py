"""Schemas of the records the jobs accept.

Money is DECIMAL(18,2): sums of decimals do not depend on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
STRING_MAP = T.MapType(T.StringType(), T.StringType())


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


S = T.StringType()
TS = T.TimestampType()
DBL = T.DoubleType()

# --- card transactions arriving on a topic, and the files matched against them ---

STREAM_TRANSACTION = _struct(
    ("transaction_id", S),
    ("merchant_id", S),
    ("user_id", S),
    ("amount", MONEY),
    ("currency", S),
    ("status", S),
    ("event_time", S),
)

STATEMENT = _struct(
    ("statement_id", S),
    ("transaction_id", S),
    ("posting_date", T.DateType()),
    ("amount_posted", MONEY),
    ("fee_charged", MONEY),
)

# Scores from 0 to 1.
ML_SIGNAL = _struct(
    ("fraud_signal_id", S),
    ("transaction_id", S),
    ("fraud_score", DBL),
    ("model_version", S),
    ("inference_time", S),
)
ML_SIGNAL_REQUIRED = [f.name for f in ML_SIGNAL.fields]

POLICY_RULE = _struct(
    ("policy_id", S),
    ("policy_type", S),
    ("rule_description", S),
    ("active_flag", T.BooleanType()),
)

# --- star schema; scores from 0 to 100 ---

USER = _struct(("user_id", S, False), ("user_name", S), ("signup_date", S))
MERCHANT = _struct(
    ("merchant_id", S, False), ("merchant_name", S), ("category", S), ("risk_level", S)
)
TRANSACTION = _struct(
    ("transaction_id", S, False),
    ("user_id", S),
    ("merchant_id", S),
    ("timestamp", S),
    ("amount", MONEY),
    ("currency", S),
    ("status", S),
    ("policy_id", S),
)
POLICY = _struct(
    ("policy_id", S, False), ("policy_name", S), ("effective_date", S), ("policy_details", S)
)
POLICY_DETAILS = _struct(("region", S), ("velocity_limit", T.IntegerType()))
FRAUD_SIGNAL = _struct(
    ("fraud_id", S),
    ("transaction_id", S),
    ("model_version", S),
    ("fraud_score", DBL),
    ("inference_time", S),
    ("reason_code", S),
)
RISK_RULE = _struct(("rule_id", S, False), ("rule_name", S), ("severity", S), ("created_at", S))

# --- nested, partitioned tables; the last two columns are the partition columns ---

COORDS = _struct(("lat", DBL), ("lon", DBL))
ITEM = _struct(
    ("sku", S), ("price", DBL), ("quantity", T.IntegerType()), ("attributes", STRING_MAP)
)

NESTED = {
    "transactions": _struct(
        ("transaction_id", S),
        ("user_id", S),
        ("merchant_id", S),
        ("items", T.ArrayType(ITEM)),
        ("transaction_time", TS),
        ("location_info", _struct(("country", S), ("city", S), ("coords", COORDS))),
        ("extra_info", STRING_MAP),
        # 0 in one row of each order; others hold more items of a very large one.
        ("part_no", T.IntegerType()),
        ("dt", S),
        ("region", S),
    ),
    "users": _struct(
        ("user_id", S),
        ("name", _struct(("first_name", S), ("last_name", S))),
        ("emails", T.ArrayType(S)),
        ("preferences", STRING_MAP),
        ("sign_up_timestamp", TS),
        ("status", S),
        ("dt", S),
        ("environment", S),
    ),
    "user_events": _struct(
        ("event_id", S),
        ("user_id", S),
        ("event_time", TS),
        (
            "event_info",
            _struct(("type", S), ("device", S), ("location", S), ("metadata", STRING_MAP)),
        ),
        ("dt", S),
        ("environment", S),
    ),
    "merchants": _struct(
        ("merchant_id", S),
        ("name", S),
        ("categories", T.ArrayType(S)),
        ("contact", _struct(("phone", S), ("email", S), ("address", STRING_MAP))),
        ("rating", DBL),
        ("dt", S),
        ("region", S),
    ),
    "fraud_signals": _struct(
        ("signal_id", S),
        ("transaction_id", S),
        ("signal_time", TS),
        ("risk_level", S),
        ("reasons", T.ArrayType(S)),
        ("details", STRING_MAP),
        ("dt", S),
        ("environment", S),
    ),
    "locations": _struct(
        ("location_id", S),
        ("region", S),
        ("name", S),
        ("coords", COORDS),
        ("attributes", STRING_MAP),
        ("dt", S),
        ("environment", S),
    ),
}


def partition_columns(table: str) -> list[str]:
    """Names of the two partition columns of a nested table."""
    return NESTED[table].names[-2:]
