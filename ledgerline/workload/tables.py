"""The five transaction sources, derived by Spark from the driver tables.

Events play the transactions, customers and nations give category and place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.aggregate import behavior_rollup
from ledgerline.operators.project import lineage_columns, nest_device, standardize, timestamp_normalize
from ledgerline.plans.decompose import decompose
from ledgerline.schemas import CUSTOMER_BEHAVIOR, DEVICE, SOURCES

NO_TELEMETRY = "signup"
NO_BEHAVIOR = "MACHINERY"

_WIDE_COLUMNS = (
    "concat('TX', event_id) AS transaction_id",
    "CAST(ts AS TIMESTAMP) AS timestamp",
    "concat('ACC', user_id) AS sender_account",
    "concat('ACC', (user_id * 7 + event_id) % 150) AS receiver_account",
    "CAST(value AS DECIMAL(18,2)) AS amount",
    "event_type AS transaction_type",
    "c_mktsegment AS merchant_category",
    "CASE WHEN event_id % 40 <> 0 THEN n_name END AS location",
    "elt(event_id % 3 + 1, 'mobile', 'web', 'pos') AS device_used",
    "(event_type = 'error' AND event_id % 3 <> 0) AS is_fraud",
    "CASE WHEN event_type = 'error' AND event_id % 3 <> 0 AND event_id % 20 <> 1 "
    "THEN elt(event_id % 2 + 1, 'identity', 'card_testing') END AS fraud_type",
    "CAST(event_id % 20 + 1 AS DECIMAL(18,2)) AS velocity_score",
    "CAST(event_id % 101 AS DOUBLE) AS geo_anomaly_score",
    "CAST(event_id % 201 - 100 AS DOUBLE) AS spending_deviation_score",
    "elt(event_id % 4 + 1, 'card', 'ach', 'wire', 'upi') AS payment_channel",
    "concat('10.', user_id % 256, '.', event_id % 256, '.1') AS ip_address",
    "md5(concat('dev-', user_id, '-', event_id % 3)) AS device_hash",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, in the layout of the wide transaction table."""
    events, customer, nation = (table(spark, sf_dir, name) for name in ("events", "customer", "nation"))
    return (
        events.join(customer, F.expr("user_id = c_custkey"), "left")
        .join(nation, F.expr("user_id % 25 = n_nationkey"), "left")
        .selectExpr(*_WIDE_COLUMNS)
    )


def raw_sources(spark: SparkSession, sf_dir: str, *names: str, gaps: bool = False) -> dict[str, DataFrame]:
    """The named sources (all five by default) as a decomposition of the wide table.

    With `gaps`, for the queries that look for missing keys, device telemetry
    lacks sign-ups and behavior lacks the accounts of one segment.
    """
    wide = wide_transactions(spark, sf_dir)
    parts = decompose(wide)
    if gaps:
        parts[DEVICE] = nest_device(wide.filter(F.col("transaction_type") != NO_TELEMETRY))
        parts[CUSTOMER_BEHAVIOR] = behavior_rollup(wide.filter(F.col("merchant_category") != NO_BEHAVIOR))
    return {name: parts[name] for name in names or SOURCES}


def bronze_sources(spark: SparkSession, sf_dir: str, *names: str, gaps: bool = False) -> dict[str, DataFrame]:
    raw = raw_sources(spark, sf_dir, *names, gaps=gaps)
    return {name: timestamp_normalize(lineage_columns(df, name)) for name, df in raw.items()}


def silver_sources(spark: SparkSession, sf_dir: str, *names: str, gaps: bool = False) -> dict[str, DataFrame]:
    return {name: standardize(df) for name, df in bronze_sources(spark, sf_dir, *names, gaps=gaps).items()}
