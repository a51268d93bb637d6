"""Sketches kept beside tables, bucketed tables, cast alerts and summaries from parts."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import aggregate as A
from ledgerline.operators import join as J
from ledgerline.operators import quality as Q
from ledgerline.operators import sketch as K
from ledgerline.operators.project import standardize, without_failures
from ledgerline.plans.gold import to_gold, write_gold
from ledgerline.plans.profiling import profile_job
from ledgerline.plans.refine import read_silver, refine
from ledgerline.sources import sinks as OUT


def hot(spark, start, end):
    """Every third key is the same, every fifth missing."""
    i = F.col("id")
    key = F.when(i % 5 == 0, F.lit(None)).when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("T"), i))
    return spark.range(start, end, 1, 4).select(key.alias("k"), i.alias("v"))


def test_merged_sketches_tell_what_a_scan_tells(spark):
    whole, batches = hot(spark, 0, 9_000), [hot(spark, 0, 2_000), hot(spark, 2_000, 9_000)]
    rows = batches[0].sparkSession.createDataFrame([], K.SKETCH_SCHEMA)
    for batch in batches:
        rows = rows.unionByName(K.sketched(batch, "s", ["k"]))
    known = K.heavy_by_column(rows, least=100)["s", "k"]
    (found,) = J.heavy_keys((whole, "k"), least=100)
    assert known == found and known.values == ("hot",) and known.nulls
    assert known.rows == found.rows == (2_400,)


def test_sketches_of_odd_tables(spark):
    assert K.sketched(hot(spark, 0, 0), "s", ["k"]).count() == 0
    assert K.heavy_by_column(spark.createDataFrame([], K.SKETCH_SCHEMA)) == {}
    binary = spark.createDataFrame([(bytearray(b"x"),)] * 50, "k binary")
    assert K.heavy_by_column(K.sketched(binary, "s", ["k"]), least=1)["s", "k"].values == ("78",)
    nothing = spark.createDataFrame([(None,)] * 50, "k string")
    assert K.heavy_by_column(K.sketched(nothing, "s", ["k"]), least=1)["s", "k"] == J.HeavyKeys((), True)


class Jobs:
    """Numbers of jobs that a session has begun."""

    def __init__(self, spark, group):
        self.context, self.group = spark.sparkContext, group

    def __enter__(self):
        self.context.setJobGroup(self.group, self.group)
        return self

    def __exit__(self, *_):
        self.count = len(self.context.statusTracker().getJobIdsForGroup(self.group))
        self.context.setLocalProperty("spark.jobGroup.id", None)


@pytest.fixture
def bronze(spark):
    def make(n=30_000, ids="even"):
        i = F.col("id")
        each = F.concat(F.lit("T"), i)
        key = F.when(i % 2 == 0, "T0").otherwise(each) if ids == "hot" else each
        base = spark.range(0, n, 1, 4)
        return {
            "payments": base.select(
                key.alias("tx_id"),
                F.lit("2024-01-01 10:00:00").alias("event_time"),
                F.when(i % 3 == 0, "A0").otherwise(F.concat(F.lit("A"), i % 500)).alias("sender_account"),
                F.when(i % 100 == 0, "?").otherwise((i % 90).cast("string")).alias("amount"),
                F.lit("Rome").alias("location"),
            ),
            "merchant": base.select(each.alias("ID"), F.lit("shop").alias("Category"), F.lit("pay").alias("Type"), i.cast("double").alias("Amount")),
            "device": base.filter(i % 7 != 0).select(each.alias("transaction_id"), F.lit("web").alias("device_used")),
            "fraud_timing": base.select(each.alias("transaction_id"), F.lit("soon").alias("timestamp"), (i % 4 == 0).alias("is_fraud"), F.when(i % 8 == 0, "x").alias("fraud_type")),
            "customer_behavior": spark.range(400).select(F.concat(F.lit("A"), "id").alias("sender_account"), F.lit(1.5).alias("avg_amount_last_24h")),
        }

    return make


def test_silver_tables_bring_their_heavy_keys(spark, bronze, tmp_path, rows):
    root = str(tmp_path / "silver")
    silver, _ = refine(spark, bronze(), root)
    assert silver.heavy["payments", "sender_account"].values == ("A0",)
    assert not silver.heavy["merchant", "transaction_id"]
    again = read_silver(spark, root)
    assert again.heavy == silver.heavy and sorted(again) == sorted(silver)
    with Jobs(spark, "plan-the-join") as jobs:
        joined = J.join_all(silver)
        gold = to_gold(silver)
    assert jobs.count == 0
    assert joined.count() == 30_000
    plan = gold._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan
    even = {name: df for name, df in silver.items()}
    assert rows(gold, "transaction_id", "row_hash")[:200] == rows(to_gold(even), "transaction_id", "row_hash")[:200]


def test_lazy_sources_are_not_scanned_while_planning(spark, bronze):
    lazy = {name: standardize(df) for name, df in bronze().items()}
    with Jobs(spark, "lazy-plan") as jobs:
        to_gold(lazy)
    assert jobs.count == 0


def test_failed_casts_are_counted_while_writing(spark, bronze, tmp_path):
    silver, alerts = refine(spark, bronze(), str(tmp_path / "silver"))
    found = {(r["source"], r["column"]): (r["observed"], r["message"]) for r in alerts.filter("check = 'cast'").collect()}
    assert found == {
        ("payments", "amount"): (300.0, "payments: 300 values of amount could not be read"),
        ("fraud_timing", "timestamp"): (30_000.0, "fraud_timing: 30000 values of timestamp could not be read"),
    }
    assert not any(c.startswith("_failed") for df in silver.values() for c in df.columns)


def test_casts_that_cannot_fail_have_no_flag(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS event_time, CAST(1 AS DECIMAL(18,2)) AS amount, 'x' AS avg_amount_last_24h")
    marked = standardize(df, failures=True)
    assert [c for c in marked.columns if c.startswith("_failed")] == ["_failed_avg_amount_last_24h"]
    assert [tuple(r) for r in A.cast_failures(marked).collect()] == [("avg_amount_last_24h", 1, 1)]
    assert A.cast_failures(standardize(df)).count() == 0
    assert without_failures(marked).columns == standardize(df).columns
    over = spark.sql("SELECT 1e30D AS amount UNION ALL SELECT CAST('NaN' AS DOUBLE) UNION ALL SELECT NULL UNION ALL SELECT 2.5D")
    assert [tuple(r) for r in A.cast_failures(standardize(over, failures=True)).collect()] == [("amount", 4, 2)]
    assert Q.cast_alerts(A.cast_failures(standardize(over, failures=True)), "s").count() == 1


# Buckets ---------------------------------------------------------------------


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_bucketed_silver_joins_and_counts_without_a_shuffle(spark, bronze, tmp_path, rows, no_broadcast):
    plain, _ = refine(spark, bronze(), str(tmp_path / "plain"))
    silver, alerts = refine(spark, bronze(), str(tmp_path / "bucketed"), buckets=6, tables="bucketed_test")
    silver.heavy.clear()
    names = ("payments", "merchant", "device", "fraud_timing")
    joined = J.transaction_join(silver)
    assert exchanges(joined) == 0
    assert exchanges(J.transaction_join(plain, heavy={})) > 0
    assert rows(joined, "transaction_id", "amount", "device_used") == rows(J.transaction_join(plain), "transaction_id", "amount", "device_used")
    census = J.key_census({n: silver[n] for n in names}, "transaction_id")
    assert exchanges(census) == 0
    assert rows(census) == rows(J.key_census({n: plain[n] for n in names}, "transaction_id"))
    assert spark.read.parquet(str(tmp_path / "bucketed" / "payments")).count() == 30_000


def test_a_source_with_a_hot_id_is_not_bucketed(spark, bronze, tmp_path, no_broadcast):
    silver, _ = refine(spark, bronze(ids="hot"), str(tmp_path / "s"), buckets=6, tables="hot_test")
    assert not spark.catalog.tableExists("hot_test_payments") and spark.catalog.tableExists("hot_test_merchant")
    assert silver.heavy["payments", "transaction_id"].values == ("T0",)
    assert J.transaction_join(silver).count() == 30_000


def test_bucketed_tables_can_be_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for n in (50, 7):
        table = OUT.write_bucketed(spark.range(n).withColumn("odd name", F.lit("x")), path, "replaced_test", "id", 3)
    assert table.count() == spark.read.parquet(path).count() == 7
    assert table.columns == ["id", "odd name"]


# Summaries from parts --------------------------------------------------------


def facts(spark):
    return spark.createDataFrame(
        [
            ("T1", "a", "p", None, 1.5, True, "2024-01-01", "x"),
            ("T1", "a", "p", "L", 2.5, True, "2024-01-02", "x"),
            ("T2", "a", "q", "L", 4.0, False, None, None),
            ("T3", None, "q", "L", 8.0, None, "2024-01-01", "y"),
            (None, "b", "q", None, 16.0, True, "2024-01-01", None),
            ("T4", "b", "q", None, None, True, "2024-01-01", "y"),
        ],
        "transaction_id string, Category string, Type string, location string, amount double, is_fraud boolean, "
        "timestamp string, fraud_type string",
    )


@pytest.mark.parametrize("key", ["Category", "Type", "location"])
def test_summaries_from_parts_equal_those_from_rows(spark, rows, key):
    df = facts(spark)
    parts = A.fraud_parts(df, ("Category", "Type", "location"))
    columns = [c for c in A.fraud_summary(df, key).columns if c != "profiling_timestamp"]
    assert rows(A.summary_of(parts, key), *columns) == rows(A.fraud_summary(df, key), *columns)
    for column in ("timestamp", "fraud_type"):
        assert rows(A.values_of(parts, key, column)) == rows(A.group_values(df, key, column))
    assert A.summary_of(A.fraud_parts(df.limit(0), (key,)), key).count() == 0


def test_parts_come_from_one_scan_and_one_shuffle(spark, tmp_path):
    facts(spark).write.parquet(str(tmp_path / "f"))
    parts = A.fraud_parts(spark.read.parquet(str(tmp_path / "f")), ("Category", "Type", "location"))
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_gold_reads_its_table_once_for_all_summaries(spark, bronze, tmp_path, rows):
    silver, _ = refine(spark, bronze(3_000), str(tmp_path / "silver"))
    tables = write_gold(spark, silver, str(tmp_path / "gold"))
    want = A.fraud_summary(tables["fraud_detection"], "Category")
    columns = [c for c in want.columns if c != "profiling_timestamp"]
    assert rows(tables["fraud_by_category"], *columns) == rows(want, *columns)
    assert tables["fraud_by_category"].schema["fraud_amount"].dataType == want.schema["fraud_amount"].dataType


# Profiles --------------------------------------------------------------------


def test_profiles_of_all_sources_are_one_write(spark, tmp_path, rows):
    for name, n in (("a", 3), ("b", 5)):
        OUT.write_parquet(spark.range(n), str(tmp_path / name))
    tables, root = {n: str(tmp_path / n) for n in "ab"}, str(tmp_path / "meta")
    OUT.write_partition(spark.createDataFrame([("old", 1.0)], "column_name string, metric_value double"), root, "c")
    found = profile_job(spark, tables, root)
    counts = found.filter("metric = 'row_count'")
    assert rows(counts, "source", "metric_value") == [("a", 3.0), ("b", 5.0)]
    assert (tmp_path / "meta" / "source=c").is_dir()


def test_a_source_that_fails_keeps_its_earlier_profile(spark, tmp_path, rows):
    for name, n in (("a", 3), ("b", 5)):
        OUT.write_parquet(spark.range(n), str(tmp_path / name))
    tables, root = {n: str(tmp_path / n) for n in "ab"}, str(tmp_path / "meta")
    profile_job(spark, tables, root)
    OUT.write_parquet(spark.range(8), str(tmp_path / "a"))
    for f in (tmp_path / "b").glob("*.parquet"):
        data = f.read_bytes()
        f.write_bytes(data[:4] + b"\xff" * 40 + data[44:])  # its pages, not its footer
    for f in (tmp_path / "b").glob(".*.crc"):
        f.unlink()
    found = profile_job(spark, tables, root).filter("metric = 'row_count'")
    assert rows(found, "source", "metric_value") == [("a", 8.0), ("b", 5.0)]
