"""JOB-01: the five sources out of one wide transaction table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators.aggregate import behavior_rollup
from ledgerline.operators.project import nest_device, project_rename
from ledgerline.schemas import (
    CUSTOMER_BEHAVIOR,
    CUSTOMER_BEHAVIOR_SCHEMA,
    DEVICE,
    DEVICE_SCHEMA,
    FRAUD_TIMING,
    MERCHANT,
    PAYMENTS,
    PAYMENTS_SCHEMA,
)
from ledgerline.sources.readers import SourceSpec
from ledgerline.sources.sinks import write_csv, write_jsonl, write_parquet, write_parquet_ms
from ledgerline.sources.together import all_together

# Old and new column names of the two flat sources.
PAYMENTS_COLUMNS = {
    "transaction_id": "tx_id",
    "timestamp": "event_time",
    "sender_account": "sender_account",
    "receiver_account": "receiver_account",
    "amount": "amount",
    "payment_channel": "payment_channel",
    "location": "location",
}
MERCHANT_COLUMNS = {
    "transaction_id": "ID",
    "merchant_category": "Category",
    "transaction_type": "Type",
    "amount": "Amount",
    "location": "Location",
}
# The columns of the wide table that the labels keep.
TIMING_COLUMNS = ("transaction_id", "timestamp", "location", "is_fraud", "fraud_type")


def payments(wide: DataFrame) -> DataFrame:
    """PRJ-02: money movement."""
    return project_rename(wide, PAYMENTS_COLUMNS)


def merchant(wide: DataFrame, missing: str | None = None) -> DataFrame:
    """PRJ-02, CST-08: merchant view, with a word for missing text if asked for."""
    frame = project_rename(wide, MERCHANT_COLUMNS)
    texts = [name for name, kind in frame.dtypes if kind == "string"]
    return frame.withColumns({c: C.as_text(F.col(c), missing) for c in texts})


def fraud_timing(wide: DataFrame, blank: float = 0.01, seed: int = 42) -> DataFrame:
    """CST-06, CST-07, DRV-03..05: labels, day parts, some locations blanked."""
    return (
        wide.select(*TIMING_COLUMNS)
        .withColumn("timestamp", C.to_milliseconds(C.coerce_timestamp(F.col("timestamp"))))
        .withColumns(
            {
                "location": C.blank_share(F.col("location"), F.col("transaction_id"), blank, seed),
                "time_of_day": C.time_of_day(F.col("timestamp")),
                "day_of_week": C.day_of_week(F.col("timestamp")),
            }
        )
    )


def unparsed_timestamps(wide: DataFrame, column: str = "timestamp") -> DataFrame:
    """CST-06: rows without a usable timestamp, the missing ones included."""
    raw = F.col(column)
    failed = C.coerce_timestamp(raw).isNull()
    return wide.agg(
        F.count_if(failed).alias("unparsed"),
        F.count_if(failed & raw.isNotNull()).alias("malformed"),
    )


def decompose(wide: DataFrame, blank: float = 0.01, seed: int = 42, missing: str | None = None) -> dict[str, DataFrame]:
    """The five raw sources as lazy frames; each reads only the columns it needs."""
    return {
        PAYMENTS: payments(wide),
        MERCHANT: merchant(wide, missing),
        DEVICE: nest_device(wide),
        CUSTOMER_BEHAVIOR: behavior_rollup(wide),
        FRAUD_TIMING: fraud_timing(wide, blank, seed),
    }


def raw_specs(root: str) -> dict[str, SourceSpec]:
    """Where `write_raw` puts each source, and how to read it."""
    return {
        PAYMENTS: SourceSpec("csv", f"{root}/payments_core", PAYMENTS_SCHEMA),
        MERCHANT: SourceSpec("parquet", f"{root}/merchant_system"),
        DEVICE: SourceSpec("jsonl", f"{root}/device_telemetry", DEVICE_SCHEMA),
        CUSTOMER_BEHAVIOR: SourceSpec("csv", f"{root}/customer_behavior", CUSTOMER_BEHAVIOR_SCHEMA),
        FRAUD_TIMING: SourceSpec("parquet", f"{root}/fraud_timing"),
    }


def write_raw(frames: Mapping[str, DataFrame], root: str) -> dict[str, SourceSpec]:
    """SNK-04..06: each source in its own format.

    A wide CSV is parsed once per source here; for a large one, write it to
    Parquet first and decompose that.
    """
    specs = raw_specs(root)

    def write(name: str, frame: DataFrame) -> None:
        spec = specs[name]
        if spec.format == "csv":
            write_csv(frame, spec.path)
        elif spec.format == "jsonl":
            write_jsonl(frame, spec.path)
        elif name == FRAUD_TIMING:
            write_parquet_ms(frame, spec.path)
        else:
            write_parquet(frame, spec.path)

    all_together({name: partial(write, name, frame) for name, frame in frames.items()})
    return specs
