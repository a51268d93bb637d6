"""JOB-04: the joined transaction table and its fraud summaries."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.aggregate import SETS, fraud_parts, summary_of, values_of
from ledgerline.operators.join import join_all
from ledgerline.operators.project import add_row_hash, utc_normalize
from ledgerline.sources.sinks import write_parquet
from ledgerline.sources.together import all_together

GOLD_TABLE = "fraud_detection"
PARTS = "_fraud_parts"
SUMMARY_KEYS = ("Category", "Type", "location")


def to_gold(silver: Mapping[str, DataFrame], strict: bool = True) -> DataFrame:
    """Join, normalize and digest.  `strict=False` keeps the lenient casts and hash."""
    return add_row_hash(utc_normalize(join_all(silver), by_name=not strict), strict)


def write_gold(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    root: str,
    keys: Iterable[str] = SUMMARY_KEYS,
    strict: bool = True,
) -> dict[str, DataFrame]:
    """Write the Gold table once; the summaries read it back, a few columns each.

    Per key, the distinct timestamps and fraud types of every group are written
    as rows, out of the same parts as the summaries.
    """

    def write(name: str, frame: DataFrame) -> DataFrame:
        write_parquet(frame, f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    def name_of(key: str) -> str:
        return f"fraud_by_{key.lower()}"

    keys = list(keys)
    gold = write(GOLD_TABLE, to_gold(silver, strict))
    # One scan of Gold and one shuffle make the distinct pairs of all summaries and sets.
    parts = write(PARTS, fraud_parts(gold, keys))
    made = {
        f"{name_of(key)}_{label}": values_of(parts, key, column) for key in keys for column, label in SETS.items()
    }
    made |= {name_of(key): summary_of(parts, key) for key in keys}
    return {GOLD_TABLE: gold, **all_together({name: partial(write, name, frame) for name, frame in made.items()})}
