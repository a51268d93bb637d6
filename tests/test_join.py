import pytest
from pyspark.sql import functions as F

from ledgerline.operators import join as J


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_left_columns_win_and_order(spark, rows):
    payments = frame(spark, [("T1", "A", 1), ("T2", "B", 2)], "transaction_id string, location string, amount int")
    merchant = frame(spark, [("T1", "x", "Z")], "transaction_id string, Category string, location string")
    joined = J.transaction_join({"payments": payments, "merchant": merchant})
    assert joined.columns == ["transaction_id", "location", "amount", "Category"]
    assert rows(joined) == [("T1", "A", 1, "x"), ("T2", "B", 2, None)]


def test_absent_sources(spark):
    payments = frame(spark, [("T1", 1)], "transaction_id string, amount int")
    assert J.transaction_join({"payments": payments, "merchant": None}).count() == 1
    with pytest.raises(ValueError, match="payments"):
        J.transaction_join({"merchant": payments})
    assert J.behavior_join(payments, None) is payments


def test_duplicates_multiply_and_null_never_matches(spark, rows):
    left = frame(spark, [("a", 1), ("b", 2), (None, 3)], "k string, l int")
    right = frame(spark, [("a", 10), ("a", 11), (None, 12)], "k string, r int")
    got = J.transaction_join({"l": left, "r": right}, ("l", "r"), "k")
    assert rows(got) == [("a", 1, 10), ("a", 1, 11), ("b", 2, None), (None, 3, None)]


def test_behavior_lineage_is_dropped(spark):
    left = frame(spark, [("a", "p")], "sender_account string, source_system string")
    right = frame(spark, [("a", "c", 5)], "sender_account string, source_system string, n int")
    got = J.behavior_join(left, right)
    assert got.columns == ["sender_account", "source_system", "n"]
    assert got.first()["source_system"] == "p"


def skewed(spark, n, hot, share, null_share=0):
    """Keys of which every third or so row is the same, with some NULLs."""
    i = F.col("id")
    key = F.when(i % share == 0, F.lit(hot)).otherwise(F.concat(F.lit("k"), i))
    if null_share:
        key = F.when(i % null_share == 1, F.lit(None)).otherwise(key)
    return spark.range(0, n, 1, 6).select(key.alias("k"), i.alias("v"))


def test_heavy_keys_are_found(spark):
    df = skewed(spark, 9000, "hot", 3, 3)
    (found,) = J.heavy_keys((df, "k"), least=100)
    assert found == J.HeavyKeys(("hot",), True)
    (even,) = J.heavy_keys((spark.range(1000).select(F.col("id").alias("k")), "k"), least=1)
    assert not even
    (none,) = J.heavy_keys((df.limit(0), "k"), least=1)
    assert not none


@pytest.mark.parametrize("left_hot, right_hot", [("h", "q"), ("h", "h"), ("q", "h")])
def test_salted_join_equals_plain_join(spark, rows, left_hot, right_hot):
    left = skewed(spark, 90, left_hot, 3, 3).union(frame(spark, [("q", -1), ("h", -2)], "k string, v long"))
    right = skewed(spark, 60, right_hot, 3, 6).withColumnRenamed("v", "w")
    l_heavy, r_heavy = J.heavy_keys((left, "k"), (right, "k"), share=0.2, least=1)
    assert l_heavy.values == (left_hot,) and r_heavy.values == (right_hot,) and l_heavy.nulls
    salted = J.left_join(left, right, "k", l_heavy, r_heavy)
    assert salted.columns == ["k", "v", "w"]
    assert rows(salted) == rows(left.join(right, "k", "left"))


def test_heavy_rows_spread_over_partitions(spark):
    left = skewed(spark, 40000, "hot", 2).repartition(64)
    right = frame(spark, [("hot", 1)], "k string, w int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        biggest = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        plain = biggest(J.left_join(left, right, "k"))
        salted = biggest(J.left_join(left, right, "k", J.HeavyKeys(("hot",))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plain > 20000 and salted < 15000


def test_stale_heavy_keys_lose_no_row(spark, rows):
    left = frame(spark, [("a", 1), ("b", 2), (None, 3)], "k string, l int")
    right = frame(spark, [("a", 10)], "k string, r int")
    for stale in (J.HeavyKeys(("b",)), J.HeavyKeys(("a", "b", "c"), True)):
        got = J.transaction_join({"l": left, "r": right}, ("l", "r"), "k", heavy={"r": stale})
        assert rows(got) == rows(left.join(right, "k", "left"))
        got = J.transaction_join({"l": left, "r": right}, ("l", "r"), "k", heavy={"l": stale})
        assert rows(got) == rows(left.join(right, "k", "left"))


def test_a_small_right_side_has_no_heavy_keys(spark):
    left = spark.range(20_000).select((F.col("id") % 250).cast("string").alias("k"), F.col("id").alias("l"))
    right = spark.range(150).select(F.col("id").cast("string").alias("k"), F.col("id").alias("r"))
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert not any(J.heavy_keys((left, "k"), (right, "k")))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert J.transaction_join({"l": left, "r": right}, ("l", "r"), "k").count() == 20_000


def test_a_key_is_heavy_at_any_number_of_partitions(spark):
    df = spark.range(200_000).select(F.when(F.col("id") < 100, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    try:
        (found,) = J.heavy_keys((df, "k"), least=50)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found.values == ("hot",)


def test_copies_follow_the_rows_of_a_key(spark):
    heavy = J.HeavyKeys(("a", "b"), rows=(1_000, 10), full=100)
    assert heavy.fans(64) == {"a": 10, "b": 2}
    assert J.HeavyKeys(("a",)).fans(64) == {"a": 64}


def test_binary_keys(spark, rows):
    left = frame(spark, [(bytearray(b"x"), i) for i in range(50)] + [(bytearray(b"\xff"), -1)], "k binary, l int")
    right = frame(spark, [(bytearray(b"x"), 7)], "k binary, r int")
    found = J.heavy_keys((left, "k"), share=0.5, least=1)[0]
    assert found.values == ("78",)
    assert rows(J.left_join(left, right, "k", found)) == rows(left.join(right, "k", "left"))


def test_salted_chain_with_hot_middle(spark, rows):
    """A key heavy in the second source only is heavy for the third join."""
    a = frame(spark, [("h", 1), ("x", 2), ("y", 3)], "k string, a int")
    b = skewed(spark, 60, "h", 2).withColumnRenamed("v", "b")
    c = frame(spark, [("h", 7), ("x", 8)], "k string, c int")
    got = J.transaction_join({"a": a, "b": b, "c": c}, ("a", "b", "c"), "k")
    want = a.join(b, "k", "left").join(c, "k", "left")
    assert rows(got) == rows(want) and got.columns == want.columns


def test_coverage_counts_distinct_missing_with_null(spark, rows):
    base = frame(spark, [("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    one = frame(spark, [("a",), ("z",)], "k string")
    two = frame(spark, [("a",), ("b",), ("c",), (None,)], "k string")
    assert rows(J.key_coverage(base, {"one": one, "two": two}, "k")) == [("one", "k", 3), ("two", "k", 0)]
    assert rows(J.missing_keys(base, one, "k")) == [("b",), ("c",), (None,)]
    assert rows(J.key_coverage(base.limit(0), {"one": one}, "k")) == [("one", "k", 0)]


def test_coverage_plan_has_one_shuffle_and_no_join(spark):
    base = spark.range(10).select(F.col("id").alias("k"))
    plan = J.key_coverage(base, {"a": base, "b": base}, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
