"""DQ operators. Every check gives rows of one alert table; none stops a write."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import quoted
from ledgerline.operators.aggregate import (
    check_counters,
    distinct_row_count,
    long_cast_failures,
    long_null_counts,
)
from ledgerline.operators.join import key_census, key_coverage
from ledgerline.schemas import (
    CAST_ALERT,
    CUSTOMER_BEHAVIOR,
    DEVICE,
    EMPTY_ALERT,
    FAILURE_ALERT,
    FRAUD_TIMING,
    MISMATCH_ALERT,
    MISSING_ALERT,
    NULLS_ALERT,
    NULL_THRESHOLD,
    PAYMENTS,
    UNIQUE_ALERT,
)
from ledgerline.sources.together import all_together

ALERT_SCHEMA = "source string, check string, column string, observed double, expected double, message string"

# Sources whose transaction ids are compared with those of payments.
COVERED_SOURCES = (DEVICE, FRAUD_TIMING)


def _alert(
    counted: DataFrame, check: str, source: str, column: str, observed: str, expected: str, message: str
) -> DataFrame:
    """Alert rows out of a small counted table; all arguments but `check` are SQL."""
    return counted.selectExpr(
        f"CAST({source} AS STRING) AS source",
        f"{quoted(check)} AS check",
        f"CAST({column} AS STRING) AS column",
        f"CAST({observed} AS DOUBLE) AS observed",
        f"CAST({expected} AS DOUBLE) AS expected",
        f"{message} AS message",
    )


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _uniqueness_alerts(counted: DataFrame, source: str, column: str) -> DataFrame:
    text = quoted(UNIQUE_ALERT.format(column=column))
    return _alert(
        counted.filter("row_count <> distinct_count"),
        "uniqueness",
        source,
        quoted(column),
        "row_count",
        "distinct_count",
        f"format_string({text}, {source}, row_count, distinct_count)",
    )


def uniqueness(df: DataFrame, source: str, column: str = "transaction_id") -> DataFrame | None:
    """DQ-01: rows against distinct values (NULL is one); None without the column."""
    if column not in df.columns:
        return None
    return _uniqueness_alerts(distinct_row_count(df, column), quoted(source), column)


def completeness(nulls: DataFrame, source: str, threshold: float = NULL_THRESHOLD) -> DataFrame:
    """DQ-02: columns whose null share is above the threshold, given `null_counts`."""
    return _alert(
        nulls.filter(f"null_share > {threshold}D"),
        "completeness",
        quoted(source),
        "column_name",
        "null_share",
        f"{threshold}D",
        f"format_string({quoted(NULLS_ALERT)}, {quoted(source)}, column_name, null_share * 100)",
    )


def cast_alerts(failures: DataFrame, source: str) -> DataFrame:
    """CST-02, CST-03, CST-06: columns with values that could not be cast, given `cast_failures`."""
    return _alert(
        failures.filter("failed_count > 0"),
        "cast",
        quoted(source),
        "column_name",
        "failed_count",
        "0",
        f"format_string({quoted(CAST_ALERT)}, {quoted(source)}, failed_count, column_name)",
    )


def row_count_alerts(counts: DataFrame, order: Iterable[str]) -> DataFrame:
    """DQ-03, DQ-04: sources without rows, and unequal counts, each as one alert.

    `counts` has a row per source; `order` is the order they are listed in.
    """
    names = ", ".join(quoted(name) for name in order)
    place = f"array_position(array({names}), source)"

    def listed(text: str, rows: str) -> str:
        item = f"CASE WHEN {rows} THEN struct({place} AS at, {text} AS text) END"
        return f"array_join(transform(sort_array(collect_list({item})), item -> item.text), ', ')"

    found = counts.selectExpr(
        "count_if(row_count = 0) AS empty",
        "count(DISTINCT row_count) AS different",
        f"{listed('source', 'row_count = 0')} AS empty_names",
        f"{listed('concat(source, chr(61), row_count)', 'true')} AS pairs",
    ).selectExpr(
        f"""stack(2,
          'empty_datasets', empty, 0, concat({quoted(EMPTY_ALERT)}, empty_names),
          'row_count_mismatch', different, 1, concat({quoted(MISMATCH_ALERT)}, pairs)
        ) AS (check, observed, expected, message)"""
    )
    return found.filter("observed > expected").selectExpr(
        "CAST(NULL AS STRING) AS source",
        "check",
        "CAST(NULL AS STRING) AS column",
        "CAST(observed AS DOUBLE) AS observed",
        "CAST(expected AS DOUBLE) AS expected",
        "message",
    )


def empty_datasets(counts: DataFrame, order: Iterable[str]) -> DataFrame:
    """DQ-03: one alert naming the sources without rows."""
    return row_count_alerts(counts, order).filter("check = 'empty_datasets'")


def row_count_mismatch(counts: DataFrame, order: Iterable[str]) -> DataFrame:
    """DQ-04: one alert with all counts if they are not the same everywhere."""
    return row_count_alerts(counts, order).filter("check = 'row_count_mismatch'")


def _coverage_alerts(counted: DataFrame, base_name: str, key: str) -> DataFrame:
    text = quoted(MISSING_ALERT.format(key=key, base=base_name))
    return _alert(
        counted.filter("missing > 0"),
        "key_coverage",
        "source",
        quoted(key),
        "missing",
        "0",
        f"format_string({text}, source, missing)",
    )


def coverage_alerts(
    base: DataFrame, base_name: str, others: Mapping[str, DataFrame], key: str
) -> DataFrame:
    """DQ-05, DQ-06: sources that lack keys of the base source."""
    return _coverage_alerts(key_coverage(base, others, key), base_name, key)


def failure_alerts(spark, failed: Iterable[str]) -> DataFrame:
    """DQ-07: one alert per source that could not be processed."""
    rows = [(name, "processing", None, None, None, FAILURE_ALERT % name) for name in failed]
    return spark.createDataFrame(rows, ALERT_SCHEMA)


def transaction_alerts(
    frames: Mapping[str, DataFrame], covered: Iterable[str] = COVERED_SOURCES, key: str = "transaction_id"
) -> DataFrame | None:
    """DQ-01 and DQ-05 over all sources with transaction ids, from one count of the keys."""
    keyed = {name: df for name, df in frames.items() if key in df.columns}
    if not keyed:
        return None
    if PAYMENTS in keyed:  # the census compares with its first frame
        keyed = {PAYMENTS: keyed[PAYMENTS], **keyed}
    counted = key_census(keyed, key)
    unique = _uniqueness_alerts(counted, "source", key)
    compared = [name for name in covered if name in keyed] if PAYMENTS in keyed else []
    if not compared:
        return unique
    return unique.unionByName(_coverage_alerts(counted.filter(F.col("source").isin(compared)), PAYMENTS, key))


def account_alerts(frames: Mapping[str, DataFrame], key: str = "sender_account") -> DataFrame | None:
    """DQ-06: accounts of payments without behavior."""
    if PAYMENTS not in frames or CUSTOMER_BEHAVIOR not in frames:
        return None
    return coverage_alerts(frames[PAYMENTS], PAYMENTS, {CUSTOMER_BEHAVIOR: frames[CUSTOMER_BEHAVIOR]}, key)


def _counted_once(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Null counts and failed casts out of one scan, whose single row all checks share."""
    counts = df.selectExpr(*check_counters(df.columns))
    row = df.sparkSession.createDataFrame(counts.collect(), counts.schema)
    return long_null_counts(row, df.columns), long_cast_failures(row, df.columns)


def alerts(
    frames: Mapping[str, DataFrame],
    threshold: float = NULL_THRESHOLD,
    covered: Iterable[str] = COVERED_SOURCES,
    failed: Iterable[str] = (),
    nulls: Mapping[str, DataFrame] | None = None,
    casts: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """DQ-08: every alert of the standardized sources as one table.

    `nulls` are the `null_counts` of the sources and `casts` their `cast_failures`
    where they are known already; otherwise each source is scanned once for both,
    here, and has the cast alerts that `standardize(failures=True)` lets it tell.
    """
    if nulls is None:
        counted = all_together({name: partial(_counted_once, df) for name, df in frames.items()})
        nulls = {name: found for name, (found, _) in counted.items()}
        casts = {name: found for name, (_, found) in counted.items()}
    counted = [df.selectExpr(f"{quoted(name)} AS source", "row_count").distinct() for name, df in nulls.items()]
    counts = _union(counted)
    checks = [
        *[completeness(counted, name, threshold) for name, counted in nulls.items()],
        *[cast_alerts(found, name) for name, found in (casts or {}).items()],
        row_count_alerts(counts, frames),
        transaction_alerts(frames, covered),
        account_alerts(frames),
    ]
    failed = list(failed)
    if failed:
        spark = next(iter(frames.values())).sparkSession
        checks.append(failure_alerts(spark, failed))
    return _union(check for check in checks if check is not None)
