"""AGG operators: fraud summaries, account behavior and counts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.functions.columns import flag_to_int, named, quoted
from ledgerline.operators.project import FAILED, dataset_tag

def fraud_amount(amount: Column, is_fraud: Column) -> Column:
    """AGG-06: sum of the amounts of fraud rows; all other rows count 0."""
    return F.sum(F.when(is_fraud.cast("boolean"), amount).otherwise(0))


def fraud_measures(df: DataFrame, key: str) -> DataFrame:
    """AGG-04, AGG-05, AGG-06 per key value; NULL is a group.

    The distinct count makes Spark shuffle on (key, transaction_id), so a key
    value that holds most rows is still spread over all tasks.
    """
    return df.groupBy(key).agg(*_measures())


def _measures() -> list[Column]:
    return [
        F.count_distinct("transaction_id").alias("fraud_transaction_count"),
        F.sum(flag_to_int(F.col("is_fraud"))).alias("fraud_count"),
        fraud_amount(F.col("amount"), F.col("is_fraud")).alias("fraud_amount"),
    ]


def group_values(df: DataFrame, key: str, column: str) -> DataFrame:
    """AGG-07 as rows: the distinct non-null values of a column in each group.

    Spread on (key, value), whatever the size of a group.
    """
    return df.select(key, column).filter(F.col(column).isNotNull()).distinct()


# Columns whose distinct values each group has, and the names of the sets.
SETS = {"timestamp": "timestamps", "fraud_type": "fraud_types"}


def set_sizes(values: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Number of values of each set of every group, from the rows of `group_values`."""
    rows = [df.select(key, F.lit(column).alias("_set")) for column, df in values.items()]
    return (
        reduce(DataFrame.unionByName, rows)
        .groupBy(key)
        .agg(*[F.count_if(F.col("_set") == column).alias(f"{SETS[column]}_size") for column in values])
    )


def fraud_by(df: DataFrame, key: str, values: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """AGG-01..AGG-07: one row per value of `key`, with measures and the sizes of its value sets.

    A set may have as many values as a group has rows, so it is no value of one
    row: all of it, at any size, are the rows of `group_values`.  `values` are
    those rows by column where they have been written already; without them the
    same shuffle that counts the transactions counts the sets.
    """
    if values is None:
        sizes = [F.count_distinct(column).alias(f"{name}_size") for column, name in SETS.items()]
        return df.groupBy(key).agg(*_measures(), *sizes)
    # At most two rows per group, each with its own columns: gather by key.
    parts = fraud_measures(df, key).unionByName(set_sizes(values, key), allowMissingColumns=True)
    gathered = parts.groupBy(key).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in parts.columns if c != key]
    )
    sizes = {f"{name}_size": F.coalesce(f"{name}_size", F.lit(0)) for name in SETS.values()}
    return gathered.withColumns(sizes)


def fraud_summary(df: DataFrame, key: str, values: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """PRJ-07 over `fraud_by`: the summary with its name and the time of the run."""
    return dataset_tag(fraud_by(df, key, values), f"fraud_by_{key.lower()}")


#: Column of a part that says which key it is grouped by, and the column whose distinct values it has.
PART_KEY, PART_VALUE = "_key", "_value"


def fraud_parts(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """AGG-01..AGG-07 for several keys from one scan: the distinct transactions, timestamps and fraud types of each group.

    Grouping sets (key, value) over every key and value column: one expansion of
    the rows and one shuffle on the pairs serve all summaries and all sets, and a
    group with most of the rows is spread by its values.  `_key` and `_value` name
    the pair of a row; its other columns are NULL.  Measures are partial.
    """
    keys, values = list(keys), ["transaction_id", *SETS]
    sets = [[key, value] for key in keys for value in values]
    pick = {
        PART_KEY: F.coalesce(*[F.when(F.grouping(key) == 0, key) for key in keys]),
        PART_VALUE: F.coalesce(*[F.when(F.grouping(value) == 0, value) for value in values]),
    }
    return df.groupingSets(sets, *keys, *values).agg(
        *[column.alias(name) for name, column in pick.items()],
        F.sum(flag_to_int(F.col("is_fraud"))).alias("fraud_count"),
        fraud_amount(F.col("amount"), F.col("is_fraud")).alias("fraud_amount"),
    )


def part_of(parts: DataFrame, key: str, value: str) -> DataFrame:
    return parts.filter((F.col(PART_KEY) == key) & (F.col(PART_VALUE) == value))


def values_of(parts: DataFrame, key: str, column: str) -> DataFrame:
    """AGG-07: the rows of `group_values`, out of the parts."""
    return part_of(parts, key, column).select(key, column).filter(F.col(column).isNotNull())


def summary_of(parts: DataFrame, key: str) -> DataFrame:
    """AGG-01..AGG-07, PRJ-07: the rows of `fraud_summary`, out of the parts.

    The pairs are distinct, so plain sums that combine in each task are left.
    """
    mine = parts.filter(F.col(PART_KEY) == key)
    is_transaction = F.col(PART_VALUE) == "transaction_id"
    # A sum of sums has ten digits more than the sum; the summary keeps the type of one sum.
    amount = parts.schema["fraud_amount"].dataType
    found = mine.groupBy(key).agg(
        F.count(F.when(is_transaction, F.col("transaction_id"))).alias("fraud_transaction_count"),
        F.sum(F.when(is_transaction, F.col("fraud_count"))).alias("fraud_count"),
        F.sum(F.when(is_transaction, F.col("fraud_amount"))).cast(amount).alias("fraud_amount"),
        *[F.count(F.when(F.col(PART_VALUE) == c, F.col(c))).alias(f"{name}_size") for c, name in SETS.items()],
    )
    return dataset_tag(found, f"fraud_by_{key.lower()}")


def behavior_rollup(df: DataFrame, key: str = "sender_account") -> DataFrame:
    """AGG-08: behavior per account over all its transactions.

    Every measure has a partial form, so an account with most of the rows
    reaches the shuffle as one row per task.
    """

    def mean(column: str) -> Column:
        return F.avg(column).cast("double")

    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            mean("amount").alias("avg_amount_last_24h"),
            F.count("transaction_id").alias("tx_count_last_24h"),
            F.max("velocity_score").alias("max_velocity_score"),
            mean("velocity_score").alias("mean_velocity_score"),
            F.min("velocity_score").alias("min_velocity_score"),
            mean("geo_anomaly_score").alias("avg_geo_anomaly_score"),
            mean("spending_deviation_score").alias("avg_spending_deviation_score"),
        )
    )


def row_count(df: DataFrame) -> DataFrame:
    """AGG-09: number of rows, as a table."""
    return df.selectExpr("count(1) AS row_count")


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """AGG-09 per source."""
    counted = [df.selectExpr(f"{quoted(name)} AS source", "count(1) AS row_count") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counted)


def distinct_row_count(df: DataFrame, column: str) -> DataFrame:
    """AGG-10: rows and distinct values of a column; NULL is one value."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .selectExpr("coalesce(sum(n), 0) AS row_count", "count(1) AS distinct_count")
    )


def _plain(columns: Iterable[str]) -> list[str]:
    return [c for c in columns if not c.startswith(FAILED)]


def check_counters(columns: Iterable[str]) -> list[str]:
    """AGG-11 as SQL aggregates of one row: rows, nulls of each column, and failed casts where the frame tells them."""
    columns = list(columns)
    return [
        "count(1) AS _rows",
        *[f"count_if({named(c)} IS NULL) AS {named(c)}" for c in _plain(columns)],
        *[f"count_if({named(c)}) AS {named(c)}" for c in columns if c.startswith(FAILED)],
    ]


def counted_row(df: DataFrame, seen: Mapping[str, int]) -> DataFrame:
    """The row of `check_counters` over `df`, as known already, without a scan."""
    names = ["_rows", *df.columns]
    schema = ", ".join(f"{named(c)} bigint" for c in names)
    return df.sparkSession.createDataFrame([tuple(seen[c] for c in names)], schema)


def long_null_counts(wide: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows and nulls of every column out of the row of `check_counters`."""
    columns = _plain(columns)
    lines = ", ".join(f"{quoted(c)}, {named(c)}" for c in columns)
    return wide.selectExpr(
        "_rows AS row_count", f"stack({len(columns)}, {lines}) AS (column_name, null_count)"
    ).selectExpr(
        "column_name",
        "row_count",
        "null_count",
        "CASE WHEN row_count > 0 THEN null_count / row_count ELSE 0.0D END AS null_share",
    )


def long_cast_failures(wide: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows and failed casts of every cast column out of the row of `check_counters`."""
    failed = [c for c in columns if c.startswith(FAILED)]
    if not failed:
        return wide.sparkSession.createDataFrame([], "column_name string, row_count bigint, failed_count bigint")
    lines = ", ".join(f"{quoted(c.removeprefix(FAILED))}, {named(c)}" for c in failed)
    counted = wide.selectExpr("_rows AS row_count", f"stack({len(failed)}, {lines}) AS (column_name, failed_count)")
    return counted.select("column_name", "row_count", "failed_count")


def null_counts(df: DataFrame) -> DataFrame:
    """AGG-11, FLT-01: rows and nulls of every column, from one scan and no data shuffle."""
    return long_null_counts(df.selectExpr(*check_counters(df.columns)), df.columns)


def cast_failures(df: DataFrame) -> DataFrame:
    """CST-02, CST-03, CST-06: rows and failed casts of every column that `standardize(failures=True)` marks, from one scan."""
    return long_cast_failures(df.selectExpr(*check_counters(df.columns)), df.columns)


def observe_nulls(df: DataFrame, observation: Observation, *more: Column) -> DataFrame:
    """The frame, counting its rows, nulls and failed casts, and `more`, while another action runs over it."""
    return df.observe(observation, *[F.expr(counter) for counter in check_counters(df.columns)], *more)


def observed_null_counts(df: DataFrame, observation: Observation) -> DataFrame:
    """AGG-11 from an observation of `df` whose action has ended: no further scan."""
    return long_null_counts(counted_row(df, observation.get), df.columns)


def observed_cast_failures(df: DataFrame, observation: Observation) -> DataFrame:
    """Failed casts from the same observation."""
    return long_cast_failures(counted_row(df, observation.get), df.columns)
