"""SCL, SRT and TOP operators over summaries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALED_MEASURES = ("fraud_transaction_count", "fraud_amount")


def measure_bounds(df: DataFrame, measures: Iterable[str] = SCALED_MEASURES) -> DataFrame:
    """AGG-13: smallest and largest value of each measure, one row."""
    return df.agg(
        *[F.min(m).alias(f"min_{m}") for m in measures],
        *[F.max(m).alias(f"max_{m}") for m in measures],
    )


def minmax_scale(df: DataFrame, measures: Iterable[str] = SCALED_MEASURES) -> DataFrame:
    """SCL-01: each measure to [0, 1]; a constant one to 0, NULL stays NULL.

    The bounds reach the rows as a scalar subquery: no join, no window.
    """
    measures = tuple(measures)
    bounds = measure_bounds(df, measures)
    ends = bounds.select(F.struct(*bounds.columns).alias("ends")).scalar()

    def scaled(name: str) -> Column:
        low = ends[f"min_{name}"].cast("double")
        high = ends[f"max_{name}"].cast("double")
        value = F.col(name).cast("double")
        return F.when(high == low, value - low).otherwise((value - low) / F.nullif(high - low, F.lit(0.0)))

    return df.withColumns({name: scaled(name) for name in measures})


def sort_desc(df: DataFrame, measure: str, *tie_break: str) -> DataFrame:
    """SRT-01: largest first, NULL last, ties in key order."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *tie_break)


def top_n(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """TOP-01: the first n with their rank; each task keeps only n rows, and only those are numbered."""
    first = sort_desc(df, measure, key).limit(n)
    order = Window.orderBy(F.col(measure).desc_nulls_last(), key)
    return first.withColumn("rank", F.row_number().over(order))


def ranked_summary(summary: DataFrame, key: str, measure: str, n: int | None = None) -> DataFrame:
    """JOB-06: scaled measures in rank order, the table behind a bar chart.

    Read the summary from a written table: its rows are few, and the bounds read it too.
    """
    scaled = minmax_scale(summary.select(key, *SCALED_MEASURES))
    return sort_desc(scaled, measure, key) if n is None else top_n(scaled, measure, key, n)
