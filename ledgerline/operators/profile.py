"""PRF operators: column profiles and their review."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import EXACT_JSON, named, quoted


PROFILE_SCHEMA = (
    "source string, column_name string, metric string, metric_value double, data_type string, "
    "ingestion_timestamp timestamp, profiling_timestamp timestamp"
)

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)


#: Bytes of a text up to which it stands for itself.
SHORT = 16


def _short(text: str) -> str:
    """SQL for a text as bytes: itself if it is short, else a mark and its 128-bit digest, which no short one equals.

    What is shuffled for a value is thus bounded, however long the texts are.
    """
    digest = f"concat(X'FF', unhex(md5(CAST({text} AS BINARY))))"
    return f"CASE WHEN octet_length({text}) <= {SHORT} THEN CAST({text} AS BINARY) ELSE {digest} END"


def _slots(field: T.StructField) -> tuple[str, str, str]:
    """SQL for a value as bytes, as whole number or as double, equal exactly when the values are.

    One of the three has the value, the others are NULL; a NULL leaves all three
    NULL.  Numbers and times keep to numbers, which are cheaper to hash than text.
    """
    column, kind = named(field.name), field.dataType
    text, whole, real = "CAST(NULL AS BINARY)", "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
    if isinstance(kind, _WHOLE):
        whole = f"CAST({column} AS BIGINT)"
    elif isinstance(kind, T.DateType):
        whole = f"CAST(unix_date({column}) AS BIGINT)"
    elif isinstance(kind, T.TimestampType):
        whole = f"unix_micros({column})"
    elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
        whole = f"CAST({column} * CAST(1{'0' * kind.scale} AS DECIMAL({kind.scale + 1},0)) AS BIGINT)"
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        real = f"CAST({column} AS DOUBLE)"
    elif isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        value = f"array_sort(map_entries({column}))" if isinstance(kind, T.MapType) else column
        options = ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in EXACT_JSON.items())
        text = _short(f"to_json({value}, map({options}))")
    elif isinstance(kind, T.BinaryType):
        text = f"CASE WHEN octet_length({column}) <= {SHORT} THEN {column} ELSE concat(X'FF', unhex(md5({column}))) END"
    else:
        text = _short(f"CAST({column} AS STRING)")
    return text, whole, real


def _columns_of(frames: Mapping[str, DataFrame]) -> list[tuple[str, T.StructField]]:
    return [(source, field) for source, df in frames.items() for field in df.schema.fields]


def column_metrics(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, nulls and distinct values (NULL is one) of every column of every source.

    `at` numbers the columns of all sources in order.  One scan per source turns
    each row into (column, value) pairs, each task reduces them to distinct
    pairs with a count, and one shuffle on the pair serves all sources: a
    frequent value or NULL leaves a task as a single row, and a column of unique
    values is spread over all tasks.
    """
    pairs, first = [], 0
    for df in frames.values():
        fields = df.schema.fields
        cells = ", ".join(", ".join((str(at), *_slots(field))) for at, field in enumerate(fields, first))
        pairs.append(df.selectExpr(f"stack({len(fields)}, {cells}) AS (at, text, whole, real)"))
        first += len(fields)
    return (
        reduce(DataFrame.unionByName, pairs)
        .groupBy("at", "text", "whole", "real")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("at")
        .agg(
            F.sum("n").alias("row_count"),
            F.expr("coalesce(sum(n) FILTER (WHERE text IS NULL AND whole IS NULL AND real IS NULL), 0)").alias("null_count"),
            F.count(F.lit(1)).alias("distinct_count"),
        )
    )


def profile_all(frames: Mapping[str, DataFrame]) -> DataFrame:
    """PRF-01, PRF-02, SET-02: four metrics per column of every source, in long form.

    A column of an empty table has zeros.
    """
    fields = _columns_of(frames)
    names = ", ".join(
        f"{at}, {quoted(source)}, {quoted(f.name)}, {quoted(f.dataType.simpleString())}"
        for at, (source, f) in enumerate(fields)
    )
    spark = next(iter(frames.values())).sparkSession
    columns = spark.range(0, 1, 1, 1).selectExpr(
        f"stack({len(fields)}, {names}) AS (at, source, column_name, data_type)"
    )
    # One row per column of the tables on either side, so the broadcast is small.
    counted = columns.join(F.broadcast(column_metrics(frames)), "at", "left")
    return counted.selectExpr(
        "source",
        "column_name",
        "data_type",
        """stack(4,
          'row_count', CAST(coalesce(row_count, 0) AS DOUBLE),
          'null_count', CAST(coalesce(null_count, 0) AS DOUBLE),
          'null_pct', CASE WHEN row_count > 0 THEN null_count / row_count * 100 ELSE 0.0D END,
          'distinct_count', CAST(coalesce(distinct_count, 0) AS DOUBLE)
        ) AS (metric, metric_value)""",
    ).selectExpr(
        "source",
        "column_name",
        "metric",
        "metric_value",
        "data_type",
        "current_timestamp() AS ingestion_timestamp",
        "current_timestamp() AS profiling_timestamp",
    )


def profile(df: DataFrame, source: str) -> DataFrame:
    """PRF-01 for one table."""
    return profile_all({source: df}).drop("profiling_timestamp")


def columns_per_source(profiles: DataFrame) -> DataFrame:
    """PRF-03: the column names of each source."""
    return profiles.groupBy("source").agg(F.sort_array(F.collect_set("column_name")).alias("column_names"))


def column_names(profiles: DataFrame) -> DataFrame:
    """PRF-04: distinct column names over all sources."""
    return profiles.select("column_name").distinct()


def data_types(profiles: DataFrame) -> DataFrame:
    """PRF-05: distinct data types."""
    return profiles.select("data_type").distinct()


def struct_columns(profiles: DataFrame) -> DataFrame:
    """PRF-06, FLT-04: profile rows of struct columns."""
    return profiles.filter(F.col("data_type").startswith("struct<"))


def row_counts_by_source(profiles: DataFrame) -> DataFrame:
    """PRF-07, FLT-02, AGG-12: rows per source as the profile saw them."""
    return (
        profiles.filter(F.col("metric") == "row_count")
        .groupBy("source")
        .agg(F.max("metric_value").alias("row_count"))
    )


def null_issues(profiles: DataFrame) -> DataFrame:
    """PRF-08, FLT-03, SRT-02: null metrics above zero, to one digit, in order."""
    return (
        profiles.filter(F.col("metric").isin("null_count", "null_pct") & (F.col("metric_value") > 0))
        .select("source", "column_name", "metric", F.bround("metric_value", 1).alias("metric_value"))
        .orderBy("source", "column_name", "metric")
    )
