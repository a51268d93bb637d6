"""PRJ, CST and DRV operators over whole frames.

Each one looks at which columns are present, so the same function serves all
five sources, and adds its columns in one projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import coerce_timestamp, row_hash, safe_decimal
from ledgerline.schemas import DECIMAL_COLUMNS, LINEAGE, MONEY, RENAMES, TIMESTAMP_COLUMNS

ROW_HASH = "row_hash"


def rename_by_map(df: DataFrame, renames: Mapping[str, str] = RENAMES) -> DataFrame:
    """PRJ-01: rename the mapped columns that are present."""
    return df.withColumnsRenamed({old: new for old, new in renames.items() if old in df.columns})


def project_rename(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """PRJ-02, PRJ-03: choose columns, giving each its new name."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])


def new_columns_only(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """PRJ-05: the key and the columns the left side does not have yet."""
    known = set(left.columns) - {key}
    return right.select(*[c for c in right.columns if c not in known])


def lineage_columns(df: DataFrame, source: str) -> DataFrame:
    """PRJ-06: name of the source and time of the run."""
    return df.withColumns({"source_system": F.lit(source), "ingestion_timestamp": F.current_timestamp()})


def dataset_tag(df: DataFrame, dataset: str) -> DataFrame:
    """PRJ-07: name of the summary and time of the run."""
    return df.withColumns({"dataset_type": F.lit(dataset), "profiling_timestamp": F.current_timestamp()})


def timestamp_normalize(df: DataFrame) -> DataFrame:
    """CST-01: timestamps without a zone become zoned ones."""
    plain = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in plain}) if plain else df


#: Before the name of a cast column: whether its value was there and could not be cast.
FAILED = "_failed_"


def cast_columns(
    df: DataFrame,
    decimals: Iterable[str] = DECIMAL_COLUMNS,
    timestamps: Iterable[str] = TIMESTAMP_COLUMNS,
    failures: bool = False,
) -> DataFrame:
    """CST-02, CST-03: named timestamp and decimal columns, bad values to NULL.

    With `failures` a boolean column for each of them says which values those
    were; a column that has its type already cannot fail and gets none.
    """
    casts = {c: coerce_timestamp(F.col(c)) for c in timestamps if c in df.columns}
    casts |= {c: safe_decimal(F.col(c)) for c in decimals if c in df.columns}
    if failures:
        kinds = {f.name: f.dataType for f in df.schema.fields}
        open_ones = [c for c in casts if not isinstance(kinds[c], (T.TimestampType, T.TimestampNTZType)) and kinds[c] != MONEY]
        casts |= {f"{FAILED}{c}": F.col(c).isNotNull() & casts[c].isNull() for c in open_ones}
    return df.withColumns(casts) if casts else df


def flatten_device(df: DataFrame) -> DataFrame:
    """PRJ-08: fields of the device and network structs as top-level columns."""
    fields = {}
    if "device" in df.columns:
        fields |= {"device_hash": F.col("device.device_hash"), "device_used": F.col("device.device_used")}
    if "network" in df.columns:
        fields |= {"ip_address": F.col("network.ip_address")}
    return df.withColumns(fields).drop("device", "network") if fields else df


def nest_device(df: DataFrame) -> DataFrame:
    """PRJ-09: the flat device columns as device and network structs."""
    return df.select(
        "transaction_id",
        F.struct("device_used", "device_hash").alias("device"),
        F.struct("ip_address").alias("network"),
    )


def add_flags(df: DataFrame) -> DataFrame:
    """DRV-01, DRV-02: missing location; fraud without a type (three-valued)."""
    flags = {}
    if "location" in df.columns:
        flags["location_missing"] = F.col("location").isNull()
    if {"is_fraud", "fraud_type"} <= set(df.columns):
        flags["is_fraud_inconsistent"] = F.col("is_fraud").cast("boolean") & F.col("fraud_type").isNull()
    return df.withColumns(flags) if flags else df


def standardize(df: DataFrame, failures: bool = False) -> DataFrame:
    """The Silver form of any source: rename, cast, flatten, flag; with `failures` also which casts failed."""
    return add_flags(flatten_device(cast_columns(rename_by_map(df), failures=failures)))


def without_failures(df: DataFrame) -> DataFrame:
    """A standardized frame without the columns that say which casts failed."""
    return df.drop(*[c for c in df.columns if c.startswith(FAILED)])


def utc_normalize(df: DataFrame, by_name: bool = False) -> DataFrame:
    """CST-04, CST-05: zoned timestamps and amount as fixed decimal.

    Timestamps are found by type.  `by_name` takes every column with "time" in
    its name instead, which turns a text column such as time_of_day to NULL.
    """
    if by_name:
        df = df.withColumns({c: coerce_timestamp(F.col(c)) for c in df.columns if "time" in c})
    else:
        df = timestamp_normalize(df)
    return df.withColumn("amount", safe_decimal(F.col("amount"))) if "amount" in df.columns else df


def add_row_hash(df: DataFrame, strict: bool = True) -> DataFrame:
    """DRV-06: digest of a row.

    Strict leaves out the lineage columns, so the same transaction has the same
    digest in every run; otherwise all columns count.
    """
    skip = {ROW_HASH, *LINEAGE} if strict else {ROW_HASH}
    return df.withColumn(ROW_HASH, row_hash([f for f in df.schema.fields if f.name not in skip], strict))
