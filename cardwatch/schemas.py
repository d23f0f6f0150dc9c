"""Declared schemas, record rules and defaults."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_LONG, _INT, _DOUBLE, _STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()
_BOOL, _DATE, _NTZ = T.BooleanType(), T.DateType(), T.TimestampNTZType()

EVENTS = _struct(
    event_id=_LONG, ts=_NTZ, user_id=_LONG, event_type=_STRING, value=_DOUBLE, props=_STRING
)
CUSTOMER = _struct(
    c_custkey=_LONG, c_name=_STRING, c_nationkey=_INT, c_acctbal=_DOUBLE, c_mktsegment=_STRING
)
NATION = _struct(n_nationkey=_INT, n_name=_STRING, n_regionkey=_INT)
EMBEDDINGS = _struct(vec_id=_LONG, embedding=T.ArrayType(T.FloatType()), label=_INT)

#: A scoring request. Optional fields may be null; see ``REQUEST_DEFAULTS``.
REQUEST = _struct(
    transaction_id=_STRING,
    amount=_DOUBLE,
    velocity_1h=_DOUBLE,
    night_tx_ratio=_DOUBLE,
    V14=_DOUBLE,
    V17=_DOUBLE,
    zscore_amount=_DOUBLE,
    zscore_amount_calc=_DOUBLE,
    velocity_1h_calc=_DOUBLE,
    risk_score=_DOUBLE,
    V4=_DOUBLE,
    V11=_DOUBLE,
    V12=_DOUBLE,
    avg_amount_7d=_DOUBLE,
    avg_amount_7d_calc=_DOUBLE,
    merchant_category=_STRING,
)

MERCHANTS = _struct(merchant_category=_STRING, sector=_STRING, base_fraud_rate=_DOUBLE)

RUNS = _struct(
    run_id=_STRING,
    experiment=_STRING,
    run_name=_STRING,
    seq=_INT,
    start_time=T.TimestampType(),
    params=T.MapType(_STRING, _STRING),
    metrics=T.MapType(_STRING, _DOUBLE),
)

MODEL_VERSIONS = _struct(
    name=_STRING, version=_INT, stage=_STRING, run_id=_STRING, path=_STRING
)

# Request fields that must be present.
REQUIRED = ["transaction_id", "amount", "velocity_1h", "night_tx_ratio", "V14", "V17"]

# Value ranges as (rule name, column, low, low is open, high, high is open).
RANGES = [
    ("amount_range", "amount", 0.0, True, 50000.0, True),
    ("velocity_1h_range", "velocity_1h", 0.0, False, 50.0, False),
    ("night_tx_ratio_range", "night_tx_ratio", 0.0, False, 1.0, False),
    ("velocity_1h_calc_range", "velocity_1h_calc", 0.0, False, 50.0, False),
    ("risk_score_range", "risk_score", 0.0, False, 1.0, False),
]

# What an absent optional request field stands for.
REQUEST_DEFAULTS = {
    "zscore_amount": 0.0,
    "zscore_amount_calc": 0.0,
    "velocity_1h_calc": 0.0,
    "risk_score": 0.1,
    "V4": 0.0,
    "V11": 0.0,
    "V12": 0.0,
    "merchant_category": "unknown",
}

# The model inputs of the published model, in order.
MODEL_FEATURES = [
    "V14",
    "V17",
    "velocity_1h_calc",
    "zscore_amount_calc",
    "amount",
    "V4",
    "V11",
    "V12",
]

# Columns that are never model inputs.
NON_FEATURES = [
    "is_fraud",
    "transaction_id",
    "transaction_date",
    "timestamp",
    "client_id",
    "merchant_category",
    "merchant_id",
    "card_type",
]

# Quality targets, each to be exceeded strictly.
KPI_TARGETS = {"precision": 0.95, "recall": 0.90, "f1": 0.92, "auc_roc": 0.98}
