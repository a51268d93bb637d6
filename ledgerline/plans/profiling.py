"""JOB-05, JOB-07: profile the Bronze tables and review the profiles."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import profile as P
from ledgerline.sources.readers import read_existing
from ledgerline.sources.sinks import write_partitions

log = logging.getLogger(__name__)


def profile_job(spark: SparkSession, tables: Mapping[str, str], root: str) -> DataFrame:
    """SNK-03, PRF-02: profile the tables that exist, in one shuffle and one write, each to its own `source=` directory.

    Directories of other sources stay as they are.  If that write fails, the
    sources are profiled one by one: one that fails then keeps its earlier
    profile and stops no other.  Returns the profiles of the sources that were
    asked for, as far as there are any.
    """
    present = read_existing(spark, tables)

    def write(frames: Mapping[str, DataFrame]) -> None:
        write_partitions(P.profile_all(frames), root)

    if present:
        try:
            write(present)
        except Exception as error:
            log.warning("profiles are written one by one", exc_info=error)
            # One after the other: dynamic overwrites of one folder must not overlap.
            for name, frame in present.items():
                try:
                    write({name: frame})
                except Exception as fault:
                    log.error("%s: profiling failed", name, exc_info=fault)
    written = read_existing(spark, {name: f"{root}/source={name}" for name in tables})
    if not written:
        return spark.createDataFrame([], P.PROFILE_SCHEMA)
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("source"), "*") for name, df in written.items()])


def review(profiles: DataFrame) -> dict[str, DataFrame]:
    """PRF-03..PRF-08 as named tables."""
    return {
        "columns_per_source": P.columns_per_source(profiles),
        "column_names": P.column_names(profiles),
        "data_types": P.data_types(profiles),
        "struct_columns": P.struct_columns(profiles),
        "row_counts": P.row_counts_by_source(profiles),
        "null_issues": P.null_issues(profiles),
    }
