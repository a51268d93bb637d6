"""JOB-03: Bronze tables to standardized Silver tables, with alerts."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession

from ledgerline.operators.aggregate import observe_nulls, observed_cast_failures, observed_null_counts
from ledgerline.operators.join import heavy_keys
from ledgerline.operators.project import standardize, without_failures
from ledgerline.operators.quality import COVERED_SOURCES, alerts, failure_alerts
from ledgerline.operators.sketch import (
    SKETCH_SCHEMA,
    SKETCHES,
    KnownKeys,
    heavy_by_column,
    observed_sketches,
    sketch_counters,
)
from ledgerline.schemas import NULL_THRESHOLD, SOURCES
from ledgerline.sources.readers import read_existing
from ledgerline.sources.sinks import write_bucketed, write_parquet
from ledgerline.sources.together import together

log = logging.getLogger(__name__)

KEY, JOIN_KEYS = "transaction_id", ("transaction_id", "sender_account")


class QualityError(RuntimeError):
    """An alert of a kind the caller does not accept."""


def refine(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    root: str,
    threshold: float = NULL_THRESHOLD,
    covered: Iterable[str] = COVERED_SOURCES,
    fail_on: Iterable[str] = (),
    buckets: int | None = None,
    tables: str = "silver",
) -> tuple[KnownKeys, DataFrame]:
    """Standardize and write each source, then check what was written.

    Rows, nulls and failed casts are counted, and the join keys sketched, while
    writing; only the key checks read the written tables, and of those just the key columns.  Alerts are kept in
    `_alerts` below the root and sketches in `_keys`; the tables that are returned know their heavy keys.  A
    failing source leaves the others alone and becomes an alert.  Alerts are
    advisory unless their check is named in `fail_on`.

    With `buckets` the sources that have transaction ids are bucketed and sorted
    by them, as catalog tables `{tables}_{source}`, and what follows joins and
    counts them without a shuffle.  A source where one id would fill a bucket
    stays as it is.
    """

    def process(name: str, frame: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, list[tuple]]:
        table, seen, path = standardize(frame, failures=True), Observation(f"checks_{name}"), f"{root}/{name}"
        keys = [c for c in JOIN_KEYS if c in table.columns]
        observed = without_failures(observe_nulls(table, seen, *sketch_counters(table, keys)))
        if buckets and KEY in keys and not heavy_keys((table, KEY), share=1.0 / buckets)[0]:
            written = write_bucketed(observed, path, f"{tables}_{name}", KEY, buckets)
        else:
            write_parquet(observed, path)
            written = spark.read.parquet(path)
        sketches = observed_sketches(spark, name, keys, seen.get["_rows"], seen.get)
        return written, observed_null_counts(table, seen), observed_cast_failures(table, seen), sketches

    done, failed = together({name: partial(process, name, frame) for name, frame in bronze.items()})
    for name, error in failed.items():
        log.error("%s: processing failed", name, exc_info=error)
    nulls = {name: found[1] for name, found in done.items()}
    casts = {name: found[2] for name, found in done.items()}
    sketches = spark.createDataFrame([row for found in done.values() for row in found[3]], SKETCH_SCHEMA)
    write_parquet(sketches, f"{root}/{SKETCHES}", files=1)
    silver = read_silver(spark, root, {name: found[0] for name, found in done.items()})
    found = alerts(silver, threshold, covered, failed, nulls, casts) if silver else failure_alerts(spark, failed)
    # Written once: whoever shows, logs or tests the alerts reads them back.
    write_parquet(found, f"{root}/_alerts", files=1)
    found = spark.read.parquet(f"{root}/_alerts")
    refused = list(fail_on)
    if refused:
        # At most one alert per check and column, so the rows are few.
        bad = [row["message"] for row in found.filter(found["check"].isin(refused)).collect()]
        if bad:
            raise QualityError("; ".join(bad))
    return silver, found


def read_silver(spark: SparkSession, root: str, frames: Mapping[str, DataFrame] | None = None) -> KnownKeys:
    """The Silver tables below a root, or those given, with the heavy keys that their sketches tell."""
    if frames is None:
        frames = read_existing(spark, {name: f"{root}/{name}" for name in SOURCES})
    sketches = read_existing(spark, {SKETCHES: f"{root}/{SKETCHES}"}).get(SKETCHES)
    return KnownKeys(frames, heavy_by_column(sketches) if sketches is not None else {})
