"""Frequent-items sketches of join keys, kept beside the tables that they describe.

A sketch is made while its table is written, merges with those of other batches,
and tells a later join which keys are heavy without a look at the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import named, quoted
from ledgerline.operators.join import LEAST_ROWS, MOST_TRACKED, HeavyKeys, comparable_key, default_share

#: Where the sketches of a layer are, below its root.
SKETCHES = "_keys"

SKETCH_SCHEMA = (
    "source string, column string, row_count bigint, null_count bigint, "
    "sketch struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"
)


def tracked_items(df: DataFrame) -> int:
    """Items that a sketch follows: enough to miss no key that would fill one of the session's shuffle partitions."""
    return min(16 * math.ceil(1.0 / default_share(df)), MOST_TRACKED)


def sketch_counters(df: DataFrame, columns: Iterable[str], tracked: int | None = None) -> list[Column]:
    """Aggregates for `observe`: a sketch of each key column, and its NULLs, gathered while another action runs."""
    tracked = tracked or tracked_items(df)
    counters = []
    for column in columns:
        text = comparable_key(df, column).cast("string")
        counters += [
            F.count_if(text.isNull()).alias(f"_nulls_{column}"),
            F.call_function("approx_top_k_accumulate", text, F.lit(tracked)).alias(f"_sketch_{column}"),
        ]
    return counters


def observed_sketches(spark: SparkSession, source: str, columns: Iterable[str], rows: int, seen: Mapping) -> list[tuple]:
    """Rows of the sketch table out of an observation that has ended; a table without rows has none."""
    if not rows:
        return []
    return [(source, c, rows, seen[f"_nulls_{c}"], tuple(seen[f"_sketch_{c}"])) for c in columns]


def sketched(df: DataFrame, source: str, columns: Iterable[str], tracked: int | None = None) -> DataFrame:
    """The sketch rows of a table that is there already, from one scan of its key columns."""
    columns = list(columns)
    seen = df.agg(F.count(F.lit(1)).alias("rows"), *sketch_counters(df, columns, tracked))
    lines = ", ".join(f"{quoted(c)}, {named(f'_nulls_{c}')}, {named(f'_sketch_{c}')}" for c in columns)
    return seen.filter("rows > 0").selectExpr(
        f"{quoted(source)} AS source", "rows AS row_count", f"stack({len(columns)}, {lines}) AS (column, null_count, sketch)"
    ).select("source", "column", "row_count", "null_count", "sketch")


def merged(sketches: DataFrame, tracked: int | None = None) -> DataFrame:
    """One row per source and column: the batches of a table put together."""
    tracked = tracked or tracked_items(sketches)
    return sketches.groupBy("source", "column").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.call_function("approx_top_k_combine", F.col("sketch"), F.lit(tracked)).alias("sketch"),
    )


def top_items(sketches: DataFrame, n: int) -> DataFrame:
    """(source, column, item, item_count): the `n` most frequent values of each column, by the sketches."""
    top = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(n))
    items = merged(sketches).select("source", "column", F.explode(top).alias("top"))
    return items.select("source", "column", F.col("top.item").alias("item"), F.col("top.count").alias("item_count"))


def heavy_by_column(
    sketches: DataFrame, share: float | None = None, least: int = LEAST_ROWS
) -> dict[tuple[str, str], HeavyKeys]:
    """Heavy keys by (source, column), as `heavy_keys` finds them, from the few rows of the sketches alone."""
    share = share or default_share(sketches)
    most = math.ceil(1.0 / share)
    tracked = min(16 * most, MOST_TRACKED)
    top = F.call_function("approx_top_k_estimate", F.col("sketch"), F.lit(min(2 * most, tracked)))
    found = {}
    for row in merged(sketches, tracked).select("source", "column", "row_count", "null_count", top.alias("top")).collect():
        entries = [(entry["item"], entry["count"]) for entry in row["top"]]
        found[row["source"], row["column"]] = HeavyKeys.of(entries, row["row_count"], row["null_count"], share, least)
    return found


class KnownKeys(dict):
    """Tables by name, with the heavy keys of their columns, so that joins need not look for them."""

    def __init__(self, frames: Mapping[str, DataFrame], heavy: Mapping[tuple[str, str], HeavyKeys]):
        super().__init__(frames)
        self.heavy = dict(heavy)
