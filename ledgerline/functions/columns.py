"""Column-to-column expressions. All of them run inside Spark's own operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schemas import MONEY

HASH_SEPARATOR = "||"


def quoted(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(column: str) -> str:
    """A column name as SQL, whatever characters it has."""
    return "`" + column.replace("`", "``") + "`"


def safe_decimal(column: Column, kind: T.DecimalType = MONEY) -> Column:
    """CST-03: fixed decimal rounded half-up; NULL for bad text, NaN or overflow."""
    return column.try_cast(kind)


def coerce_timestamp(column: Column) -> Column:
    """CST-02, CST-06: timestamp, NULL where the value is not one."""
    return column.try_cast(T.TimestampType())


def to_milliseconds(column: Column) -> Column:
    """CST-07: drop what is finer than a millisecond."""
    return F.date_trunc("MILLISECOND", column)


def as_text(column: Column, missing: str | None = None) -> Column:
    """CST-08: text form; a word for missing values only when asked for."""
    text = column.cast("string")
    return text if missing is None else F.coalesce(text, F.lit(missing))


def flag_to_int(column: Column) -> Column:
    """CST-09: boolean (or 0/1) to integer, NULL stays NULL."""
    return column.cast("int")


def time_of_day(timestamp: Column) -> Column:
    """DRV-03: part of the day by hour; an unknown time counts as night."""
    hour = F.hour(timestamp)
    return (
        F.when(hour.between(5, 11), "morning")
        .when(hour.between(12, 17), "afternoon")
        .otherwise("night")
    )


def day_of_week(timestamp: Column) -> Column:
    """DRV-04: English weekday name."""
    return F.date_format(timestamp, "EEEE")


def chosen_share(key: Column, share: float, seed: int = 42) -> Column:
    """True for about `share` of the keys, to a hundredth of a percent.

    The choice depends only on seed and key, so a re-run task or another
    partitioning picks the same rows.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}-"), key.cast("string")))
    if 0 < share * 10_000 < 1:
        raise ValueError(f"a share of {share} is below the resolution of a hundredth of a percent")
    bucket = F.conv(F.substring(digest, 1, 6), 16, 10).cast("bigint") % 10_000
    return bucket < round(share * 10_000)


def blank_share(column: Column, key: Column, share: float = 0.01, seed: int = 42) -> Column:
    """DRV-05: the column with about `share` of its values set to NULL."""
    return F.when(F.coalesce(chosen_share(key, share, seed), F.lit(False)), F.lit(None)).otherwise(column)


# Finer than a millisecond and free of the session's zone, so that values are equal in text when they are equal.
EXACT_JSON = {
    "ignoreNullFields": "false",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def exact_text(field: T.StructField) -> Column:
    """A value as text that is equal exactly when the values are, in any session; NULL stays NULL.

    Times are counts since the epoch, nested values are JSON, and the entries of
    a map stand in key order.
    """
    column, kind = F.col(named(field.name)), field.dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(column)), EXACT_JSON)
    if isinstance(kind, (T.StructType, T.ArrayType)):
        return F.to_json(column, EXACT_JSON)
    return column.cast("string")


def row_hash(fields: Sequence[T.StructField], strict: bool = True) -> Column:
    """DRV-06: SHA-256 over the columns as text.

    Strict: sorted by name, each value after its length and NULL as a mark of its
    own, so that no two different rows give one text, whatever the column order,
    the values or the session's zone.  Otherwise the given order is kept, values
    are joined by a separator and NULLs are skipped.
    """
    if not strict:
        return F.sha2(F.concat_ws(HASH_SEPARATOR, *[F.col(named(f.name)).cast("string") for f in fields]), 256)
    parts = []
    for field in sorted(fields, key=lambda f: f.name):
        text = exact_text(field)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(F.lit(""), *parts), 256)
