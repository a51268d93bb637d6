"""Fixed names, schemas and defaults of the five transaction sources."""

from __future__ import annotations

from pyspark.sql import types as T

PAYMENTS = "payments"
MERCHANT = "merchant"
DEVICE = "device"
CUSTOMER_BEHAVIOR = "customer_behavior"
FRAUD_TIMING = "fraud_timing"

SOURCES = (PAYMENTS, MERCHANT, DEVICE, CUSTOMER_BEHAVIOR, FRAUD_TIMING)

# Sources joined on transaction_id, the left one first.
TRANSACTION_SOURCES = (PAYMENTS, MERCHANT, DEVICE, FRAUD_TIMING)

LINEAGE = ("source_system", "ingestion_timestamp")

# Column renames, decimal columns and the null-share limit.
RENAMES = {
    "transactionId": "transaction_id",
    "tx_id": "transaction_id",
    "ID": "transaction_id",
    "Amount": "amount",
    "Location": "location",
}
DECIMAL_COLUMNS = (
    "amount",
    "avg_amount_last_24h",
    "max_velocity_score",
    "mean_velocity_score",
    "min_velocity_score",
)
TIMESTAMP_COLUMNS = ("event_time", "timestamp")
NULL_THRESHOLD = 0.05

MONEY = T.DecimalType(18, 2)

# The sentences of the alerts, as format strings.
UNIQUE_ALERT = "%s: {column} not unique (%d rows vs %d distinct)"
NULLS_ALERT = "%s: %s has %.2f%% nulls"
EMPTY_ALERT = "Empty datasets detected: "
MISMATCH_ALERT = "Row count mismatch across sources: "
MISSING_ALERT = "%s: %d {key}s missing vs {base}"
FAILURE_ALERT = "%s: processing failed"

# A sentence of this library's own.
CAST_ALERT = "%s: %d values of %s could not be read"


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


_S, _D, _L, _B = T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType()

WIDE_SCHEMA = _fields(
    ("transaction_id", _S),
    ("timestamp", _S),
    ("sender_account", _S),
    ("receiver_account", _S),
    ("amount", _D),
    ("transaction_type", _S),
    ("merchant_category", _S),
    ("location", _S),
    ("device_used", _S),
    ("is_fraud", _B),
    ("fraud_type", _S),
    ("velocity_score", _D),
    ("geo_anomaly_score", _D),
    ("spending_deviation_score", _D),
    ("payment_channel", _S),
    ("ip_address", _S),
    ("device_hash", _S),
)

# The columns of the raw files, in their order.
# CSV and JSON carry no types, and inference reads short ids such as "T12" as
# timestamps, so these sources have a schema. Parquet brings its own.
PAYMENTS_SCHEMA = _fields(
    ("tx_id", _S),
    ("event_time", T.TimestampType()),
    ("sender_account", _S),
    ("receiver_account", _S),
    ("amount", _D),
    ("payment_channel", _S),
    ("location", _S),
)
DEVICE_SCHEMA = _fields(
    ("transaction_id", _S),
    ("device", _fields(("device_used", _S), ("device_hash", _S))),
    ("network", _fields(("ip_address", _S))),
)
CUSTOMER_BEHAVIOR_SCHEMA = _fields(
    ("sender_account", _S),
    ("avg_amount_last_24h", _D),
    ("tx_count_last_24h", _L),
    ("max_velocity_score", _D),
    ("mean_velocity_score", _D),
    ("min_velocity_score", _D),
    ("avg_geo_anomaly_score", _D),
    ("avg_spending_deviation_score", _D),
)
