from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import aggregate as A

SCHEMA = (
    "Category string, transaction_id string, is_fraud boolean, amount decimal(18,2), timestamp string, "
    "fraud_type string"
)


def facts(spark):
    rows = [
        ("a", "T1", True, Decimal("10.00"), "2024-01-02", "x"),
        ("a", "T1", True, Decimal("10.00"), "2024-01-02", "x"),
        ("a", "T2", False, Decimal("5.00"), "2024-01-01", None),
        ("a", None, None, Decimal("7.00"), None, "y"),
        ("a", "T3", True, None, "2024-01-03", "x"),
        ("b", "T4", None, Decimal("1.00"), None, None),
        (None, "T5", True, Decimal("2.50"), "2024-01-01", None),
    ]
    return spark.createDataFrame(rows, SCHEMA).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def test_fraud_by(spark, rows):
    whole = [("a", 3, 3, Decimal("20.00"), 3, 2), ("b", 1, None, Decimal("0.00"), 0, 0), (None, 1, 1, Decimal("2.50"), 1, 0)]
    got = A.fraud_by(facts(spark), "Category")
    assert rows(got) == whole
    assert dict(got.dtypes)["fraud_amount"] == "decimal(28,2)"
    values = {c: A.group_values(facts(spark), "Category", c) for c in A.SETS}
    counted = A.fraud_by(facts(spark), "Category", values)
    assert rows(counted) == whole and counted.columns == got.columns


def test_a_set_of_any_size_is_complete(spark):
    n = 200_000
    df = spark.range(n).select(
        F.lit("a").alias("Category"),
        F.col("id").cast("string").alias("transaction_id"),
        F.lit(True).alias("is_fraud"),
        F.lit(1).cast("decimal(18,2)").alias("amount"),
        F.timestamp_seconds("id").alias("timestamp"),
        F.lit("x").alias("fraud_type"),
    )
    assert A.group_values(df, "Category", "timestamp").count() == n
    assert A.fraud_by(df, "Category").first()["timestamps_size"] == n


def test_no_rows(spark):
    assert A.fraud_by(facts(spark).limit(0), "Category").count() == 0


def test_group_sums_equal_the_total(spark):
    df = spark.range(1000).select(
        (F.col("id") % 7).cast("string").alias("Category"),
        F.col("id").cast("string").alias("transaction_id"),
        (F.col("id") % 5 == 0).alias("is_fraud"),
        F.col("id").cast("decimal(18,2)").alias("amount"),
    )
    total = A.fraud_measures(df, "Category").agg(F.sum("fraud_count"), F.sum("fraud_amount")).first()
    assert tuple(total) == (200, sum(range(0, 1000, 5)))


def test_summary_is_tagged(spark):
    got = A.fraud_summary(facts(spark), "Category")
    assert got.columns[-2:] == ["dataset_type", "profiling_timestamp"]
    assert {r[0] for r in got.select("dataset_type").collect()} == {"fraud_by_category"}


def test_behavior_rollup(spark, rows):
    data = [
        ("a", "T1", 1.0, 2.0, 3.0, 4.0),
        ("a", None, None, 4.0, 5.0, None),
        (None, "T3", 9.0, 9.0, 9.0, 9.0),
    ]
    df = spark.createDataFrame(
        data,
        "sender_account string, transaction_id string, amount double, velocity_score double, "
        "geo_anomaly_score double, spending_deviation_score double",
    )
    assert rows(A.behavior_rollup(df)) == [("a", 1.0, 1, 4.0, 3.0, 2.0, 4.0, 4.0)]


def test_counts(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, None)], "k string, n int")
    assert rows(A.distinct_row_count(df, "k")) == [(3, 2)]
    assert rows(A.distinct_row_count(df.limit(0), "k")) == [(0, 0)]
    assert rows(A.null_counts(df)) == [("k", 3, 1, 1 / 3), ("n", 3, 2, 2 / 3)]
    assert rows(A.null_counts(df.limit(0))) == [("k", 0, 0, 0.0), ("n", 0, 0, 0.0)]
    assert rows(A.row_counts({"x": df, "y": df.limit(1)})) == [("x", 3), ("y", 1)]
