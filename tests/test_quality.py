from pyspark.sql import functions as F

from ledgerline.operators import aggregate as A
from ledgerline.operators import quality as Q


def messages(df):
    return [r["message"] for r in df.orderBy("message").collect()]


def test_uniqueness_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "transaction_id string")
    alert = Q.uniqueness(df, "payments")
    assert alert.columns == ["source", "check", "column", "observed", "expected", "message"]
    assert [tuple(r) for r in alert.collect()] == [
        (
            "payments",
            "uniqueness",
            "transaction_id",
            3.0,
            2.0,
            "payments: transaction_id not unique (3 rows vs 2 distinct)",
        )
    ]
    assert Q.uniqueness(df.distinct(), "payments").count() == 0
    assert Q.uniqueness(spark.range(1), "payments") is None


def test_completeness_is_strict(spark):
    df = spark.range(100).select(
        F.when(F.col("id") >= 5, 1).alias("at_limit"), F.when(F.col("id") >= 6, 1).alias("above")
    )
    assert messages(Q.completeness(A.null_counts(df), "s")) == ["s: above has 6.00% nulls"]
    assert Q.completeness(A.null_counts(df.limit(0)), "s").count() == 0


def test_row_count_checks(spark):
    frames = {"b": spark.range(2), "a": spark.range(2), "z": spark.range(0), "y": spark.range(0)}
    counts = A.row_counts(frames)
    assert messages(Q.empty_datasets(counts, frames)) == ["Empty datasets detected: z, y"]
    assert messages(Q.row_count_mismatch(counts, frames)) == [
        "Row count mismatch across sources: b=2, a=2, z=0, y=0"
    ]
    same = A.row_counts({"a": spark.range(2), "b": spark.range(2)})
    assert messages(Q.empty_datasets(same, ["a", "b"]).union(Q.row_count_mismatch(same, ["a", "b"]))) == []


def sources(spark):
    return {
        "payments": spark.createDataFrame(
            [("T1", "A"), ("T2", "B"), ("T3", "B")], "transaction_id string, sender_account string"
        ),
        "device": spark.createDataFrame([("T1",), ("T9",), ("T8",)], "transaction_id string"),
        "fraud_timing": spark.createDataFrame([("T1",), ("T2",), ("T3",)], "transaction_id string"),
        "customer_behavior": spark.createDataFrame([("A",), ("C",), ("D",)], "sender_account string"),
    }


def test_alert_table(spark):
    found = Q.alerts(sources(spark), failed=["merchant"])
    assert messages(found) == [
        "customer_behavior: 1 sender_accounts missing vs payments",
        "device: 2 transaction_ids missing vs payments",
        "merchant: processing failed",
    ]
    assert found.schema.simpleString() == (
        "struct<source:string,check:string,column:string,observed:double,expected:double,message:string>"
    )


def test_coverage_of_named_sources_only(spark):
    frames = sources(spark)
    frames["fraud_timing"] = frames["fraud_timing"].filter("transaction_id <> 'T3'")
    both = messages(Q.alerts(frames))
    assert "fraud_timing: 1 transaction_ids missing vs payments" in both
    one = messages(Q.alerts(frames, covered=["device"]))
    assert not any(m.startswith("fraud_timing: 1 ") for m in one)
    del frames["payments"]
    assert not any("missing vs" in m for m in messages(Q.alerts(frames)))


def test_observed_counts_equal_counted(spark, rows, tmp_path):
    from pyspark.sql import Observation

    df = spark.createDataFrame([("a", 1), (None, None)], "k string, n int")
    seen = Observation("t")
    A.observe_nulls(df, seen).write.parquet(str(tmp_path / "t"))
    assert rows(A.observed_null_counts(df, seen)) == rows(A.null_counts(df))
