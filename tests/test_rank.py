from decimal import Decimal

from ledgerline.operators import rank as R

SCHEMA = "location string, fraud_transaction_count bigint, fraud_amount decimal(28,2)"


def test_scaled_to_unit_interval(spark):
    data = [("a", 10, Decimal("1.00")), ("b", 20, Decimal("3.00")), ("c", 15, None), (None, 10, Decimal("2.00"))]
    got = R.minmax_scale(spark.createDataFrame(data, SCHEMA)).orderBy("fraud_transaction_count", "location")
    assert [tuple(r) for r in got.collect()] == [
        (None, 0.0, 0.5),
        ("a", 0.0, 0.0),
        ("c", 0.5, None),
        ("b", 1.0, 1.0),
    ]


def test_constant_measure_is_zero(spark):
    data = [("a", 5, Decimal("1.00")), ("b", 5, None)]
    got = [tuple(r) for r in R.minmax_scale(spark.createDataFrame(data, SCHEMA)).orderBy("location").collect()]
    assert got == [("a", 0.0, 0.0), ("b", 0.0, None)]


def test_rank_order_and_limit(spark):
    data = [(f"L{i:02d}", i // 2, Decimal(i)) for i in range(30)] + [("none", 3, None)]
    summary = spark.createDataFrame(data, SCHEMA)
    top = [r["location"] for r in R.ranked_summary(summary, "location", "fraud_transaction_count", n=20).collect()]
    assert R.ranked_summary(summary, "location", "fraud_amount", n=20).agg({"rank": "max"}).first()[0] == 20
    assert len(top) == 20 and top[:4] == ["L28", "L29", "L26", "L27"]
    every = [r["location"] for r in R.ranked_summary(summary, "location", "fraud_amount").collect()]
    assert every[0] == "L29" and every[-1] == "none" and len(every) == 31


def test_top_n_plan(spark):
    summary = spark.createDataFrame([("a", 1, Decimal(1))], SCHEMA)
    plan = R.ranked_summary(summary, "location", "fraud_amount", n=5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # Only the limited rows are numbered.
    assert plan.index("Window") < plan.index("TakeOrderedAndProject")


def test_bounds(spark):
    data = [("a", 5, Decimal("1.00")), ("b", 7, Decimal("0.50"))]
    assert tuple(R.measure_bounds(spark.createDataFrame(data, SCHEMA)).first()) == (5, Decimal("0.50"), 7, Decimal("1.00"))
