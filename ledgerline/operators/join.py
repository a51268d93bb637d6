"""JON operators: left joins that survive heavy keys, and key coverage."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import named, quoted
from ledgerline.operators.project import new_columns_only
from ledgerline.schemas import CUSTOMER_BEHAVIOR, LINEAGE, PAYMENTS, TRANSACTION_SOURCES

_SALT, _TASK, _HIT, _FAN, _SIDE, _THERE = "_salt", "_task", "_hit", "_fan", "_side", "_there"

# Rows below which no key is worth a salt, and the most items that Spark's sketch tracks.
LEAST_ROWS = 10_000
MOST_TRACKED = 1_000_000


@dataclass(frozen=True)
class HeavyKeys:
    """Key values that alone would fill a partition, with their rows, and whether NULL does.

    `rows` are those of each value, and `full` those that fill a partition; both
    are estimates and set only how many tasks share a key.
    """

    values: tuple = ()
    nulls: bool = False
    rows: tuple[int, ...] = field(default=(), compare=False)
    full: int = field(default=LEAST_ROWS, compare=False)

    def __bool__(self) -> bool:
        return bool(self.values) or self.nulls

    @classmethod
    def of(cls, top: Iterable[tuple[str | None, int]], rows: int, nulls: int, share: float, least: int) -> "HeavyKeys":
        """Out of the most frequent items of a column with `rows` rows: those that hold `share` of them, and `least`."""
        floor = max(share * rows, least)
        kept = [(item, count) for item, count in top if item is not None and count >= floor]
        return cls(tuple(item for item, _ in kept), floor <= nulls, tuple(count for _, count in kept), max(int(floor), 1))

    def __or__(self, other: "HeavyKeys") -> "HeavyKeys":
        """Heavy in either; a key of both has the rows that their join makes of it."""
        counts = dict(zip(self.values, self.rows))
        for value, rows in zip(other.values, other.rows):
            counts[value] = min(counts.get(value, 1) * rows, 1 << 62)
        values = tuple(dict.fromkeys(self.values + other.values))
        known = tuple(counts[v] for v in values) if all(v in counts for v in values) else ()
        return HeavyKeys(values, self.nulls or other.nulls, known, max(self.full, other.full))

    def fans(self, most: int) -> dict:
        """Tasks to share each key: as many partitions as its rows fill, `most` where they are not known."""
        if not self.rows:
            return dict.fromkeys(self.values, most)
        return {v: max(2, min(most, -(-n // self.full))) for v, n in zip(self.values, self.rows)}


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def default_share(df: DataFrame) -> float:
    """The share of the rows with which a key alone fills a shuffle partition."""
    return 1.0 / max(_partitions(df), 20)


def comparable_key(df: DataFrame, key: str) -> Column:
    """The key in a form that the sketch and a literal can hold."""
    column = F.col(f"`{key}`")
    return F.hex(column) if isinstance(df.schema[key].dataType, T.BinaryType) else column


def heavy_keys(
    *targets: tuple[DataFrame, str], share: float | None = None, least: int = LEAST_ROWS
) -> list[HeavyKeys]:
    """For each (frame, key column), the values holding at least `share` of its rows, and `least` rows.

    Runs one job over all targets: narrow scans that keep a frequent-items sketch
    per task and shuffle no keys.  At most 1/share values can qualify, so the
    answer is small whatever the data; the sketch tracks enough items to miss
    none of them.  By default a key is heavy when it alone would fill a shuffle
    partition, however many partitions there are.
    """
    if share is None:
        share = default_share(targets[0][0])
    most = math.ceil(1.0 / share)
    tracked = min(16 * most, MOST_TRACKED)
    sketches = [
        df.select(comparable_key(df, key).alias("key")).agg(
            F.lit(at).alias("at"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("key").isNull()).alias("nulls"),
            F.transform(
                F.expr(f"approx_top_k(key, {min(2 * most, tracked)}, {tracked})"),
                lambda x: F.struct(x["item"].cast("string").alias("item"), x["count"].alias("count")),
            ).alias("top"),
        )
        for at, (df, key) in enumerate(targets)
    ]
    found = {row["at"]: row for row in reduce(DataFrame.union, sketches).collect()}

    def heavy(at: int) -> HeavyKeys:
        row = found[at]
        top = [(entry["item"], entry["count"]) for entry in row["top"] or ()]
        return HeavyKeys.of(top, row["rows"], row["nulls"], share, least)

    return [heavy(at) for at in range(len(targets))]


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_heavy: HeavyKeys = HeavyKeys(),
    right_heavy: HeavyKeys = HeavyKeys(),
) -> DataFrame:
    """USING left join, with the rows of heavy keys spread over several partitions.

    Without heavy keys this is the plain join, and the optimizer picks its form.
    A key heavy on the left is dealt out by task and its right rows are copied to
    its salts.  A key heavy only on the right is dealt out there and its left
    rows are copied; whether such a key has a match is looked up in the right
    side itself, so a left row is copied only if it does, and the copies that
    meet none are dropped.  The result is exact whatever the heavy keys are, also
    if they were found before a table changed.  Left NULL keys match nothing and
    are only dealt out.  A key has as many salts as its rows fill partitions, so
    there are fewer copies than rows of the result.  The salt is the number of
    the task that holds the row: a task run again gives the same one.
    """
    on_left = left_heavy.values
    on_right = tuple(v for v in right_heavy.values if v not in on_left)
    if not (on_left or on_right or left_heavy.nulls):
        return left.join(right, key, "left")

    most = 8 * _partitions(left)
    fans = {v: (n, "l") for v, n in left_heavy.fans(most).items()}
    fans |= {v: (n, "r") for v, n in right_heavy.fans(most).items() if v not in fans}
    plan = left.sparkSession.createDataFrame(
        [(v, n, side) for v, (n, side) in fans.items()], f"_heavy string, {_FAN} int, {_SIDE} string"
    )
    k = F.col(f"`{key}`")

    def planned(df: DataFrame) -> DataFrame:
        # The plan has a row per heavy key, at most one per shuffle partition.
        return df.join(F.broadcast(plan), comparable_key(df, key).cast("string") == F.col("_heavy"), "left").drop("_heavy")

    def salted(df: DataFrame, dealt: Column, copied: Column) -> DataFrame:
        task, every = F.array(F.pmod(F.spark_partition_id(), F.col(_FAN))), F.sequence(F.lit(0), F.col(_FAN) - 1)
        salts = F.when(dealt, task).when(copied, every).otherwise(F.array(F.lit(0)))
        return df.withColumn(_SALT, F.explode(salts))

    is_left, is_right = F.coalesce(F.col(_SIDE) == "l", F.lit(False)), F.coalesce(F.col(_SIDE) == "r", F.lit(False))
    spread_left = planned(left)
    if on_right:
        there = planned(right).filter(is_right).select(key).distinct().withColumn(_THERE, F.lit(True))
        spread_left = spread_left.join(F.broadcast(there), key, "left").withColumn(_THERE, F.coalesce(_THERE, F.lit(False)))
    else:
        spread_left = spread_left.withColumn(_THERE, F.lit(False))
    null_fan = F.when(k.isNull() & F.lit(left_heavy.nulls), F.lit(most)).otherwise(F.col(_FAN))
    spread_left = spread_left.withColumn(_FAN, null_fan)
    spread_left = salted(spread_left, is_left | (k.isNull() & F.lit(left_heavy.nulls)), is_right & F.col(_THERE))
    spread_right = salted(planned(right.filter(k.isNotNull())), is_right, is_left).drop(_FAN, _SIDE).withColumn(_HIT, F.lit(True))
    joined = spread_left.join(spread_right, [key, _SALT], "left")
    if on_right:
        joined = joined.filter(F.col(_HIT).isNotNull() | ~F.col(_THERE))
    return joined.select(*[c for c in joined.columns if c not in (_SALT, _HIT, _FAN, _SIDE, _THERE)])


def transaction_join(
    sources: Mapping[str, DataFrame],
    order: Iterable[str] = TRANSACTION_SOURCES,
    key: str = "transaction_id",
    heavy: Mapping[str, HeavyKeys] | None = None,
) -> DataFrame:
    """JON-01: left-join the later sources to the first, USING the key.

    Left columns win name clashes, an absent source is skipped, an absent first
    source is an error.  Duplicate keys on the right multiply rows.  `heavy`
    names the heavy keys per source; without it those that the sources bring
    along count (`sketch.KnownKeys`), and sources without any are taken as even:
    no job runs here.  `heavy_keys` looks for them in a scan.
    """
    first, *rest = order
    if sources.get(first) is None:
        raise ValueError(f"source {first} is missing: nothing to join the others to")
    present = [name for name in rest if sources.get(name) is not None]
    if heavy is None:
        heavy = {name: known_heavy(sources, name, key) for name in (first, *present)}
    joined, seen = sources[first], heavy.get(first, HeavyKeys())
    for name in present:
        right = new_columns_only(joined, sources[name], key)
        theirs = heavy.get(name, HeavyKeys())
        joined = left_join(joined, right, key, seen, theirs)
        # Matches of a key heavy on the right make it heavy in the result too.
        seen = seen | HeavyKeys(theirs.values, rows=theirs.rows, full=theirs.full)
    return joined


def behavior_join(
    df: DataFrame,
    behavior: DataFrame | None,
    key: str = "sender_account",
    heavy: HeavyKeys | None = None,
) -> DataFrame:
    """JON-02: left-join per-account behavior; pass through when it is absent.

    One account may send a large share of all payments, so the rows of `heavy`
    keys are dealt out; without any the join is the plain one.
    """
    if behavior is None:
        return df
    return left_join(df, behavior.drop(*LINEAGE), key, heavy or HeavyKeys())


def known_heavy(sources: Mapping[str, DataFrame], name: str, key: str) -> HeavyKeys:
    """The heavy keys that a mapping of tables brings along for a column, none if it brings none."""
    return getattr(sources, "heavy", {}).get((name, key), HeavyKeys())


def join_all(sources: Mapping[str, DataFrame]) -> DataFrame:
    """JON-01 then JON-02, with the heavy keys that the sources bring along."""
    joined = transaction_join(sources)
    return behavior_join(
        joined, sources.get(CUSTOMER_BEHAVIOR), heavy=known_heavy(sources, PAYMENTS, "sender_account")
    )


def key_census(frames: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Per frame: rows, distinct keys, and distinct keys of the first frame it lacks.

    NULL is one key.  One shuffle on the key serves all frames, after each task
    has reduced its rows to one per key and frame; no join, so a key that holds
    most rows costs nothing extra.
    """
    marks = range(len(frames))
    tagged = [df.selectExpr(f"{named(key)} AS key", f"{at} AS at") for at, df in zip(marks, frames.values())]
    per_key = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("key")
        .agg(*[F.expr(f"count_if(at = {at}) AS n{at}") for at in marks])
    )
    lines = ", ".join(
        f"{quoted(name)}, coalesce(sum(n{at}), 0), count_if(n{at} > 0), count_if(n0 > 0 AND n{at} = 0)"
        for at, name in zip(marks, frames)
    )
    return per_key.selectExpr(
        f"stack({len(frames)}, {lines}) AS (source, row_count, distinct_count, missing)"
    ).selectExpr("source", f"{quoted(key)} AS key", "row_count", "distinct_count", "missing")


def key_coverage(base: DataFrame, others: Mapping[str, DataFrame], key: str) -> DataFrame:
    """JON-03: number of distinct keys of `base` missing in each other frame."""
    census = key_census({"": base, **others}, key)
    return census.filter(F.col("source") != "").select("source", "key", "missing")


def missing_keys(base: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """JON-03, SET-03: distinct keys of `base` that `other` lacks."""
    here, there = (df.select(F.col(f"`{key}`"), F.lit(side).alias("side")) for side, df in ((1, base), (2, other)))
    return here.unionByName(there).groupBy(key).agg(F.max("side").alias("last")).filter("last = 1").select(key)
