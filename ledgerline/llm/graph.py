"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import discard, if_small, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); a label is the smallest node that can be reached.

    Each step links all larger neighbours of a node to its smallest neighbour,
    then does so for the smaller ones; the number of steps grows with the
    logarithm of a component's size.  Neighbours are never gathered: a step is
    a minimum per node, combined in each task first, and an equi-join, which
    adaptive execution splits at the centre of a large star; the minima of a
    small graph go to all tasks instead.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = written(edges.filter("a <> b").select(larger, smaller), "edges")
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(if_small(low, 2 * seen[0]), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(if_small(low, 2 * seen[0]), "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))).alias("e"))
        after = written(small.select(F.col("e.a"), F.col("e.m").alias("b")).filter("a <> b").distinct(), "edges")
        after_seen = state(after)
        if after_seen == seen:
            discard(after)
            break
        discard(now)
        now, seen = after, after_seen
    tops = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        tops.select(F.col("b").alias("node"), F.col("b").alias("label"))
    )
