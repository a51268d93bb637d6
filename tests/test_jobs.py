import pytest
from pyspark.sql import functions as F

from ledgerline.plans import decompose as D
from ledgerline.plans.gold import GOLD_TABLE, to_gold, write_gold
from ledgerline.plans.profiling import profile_job, review
from ledgerline.plans.refine import QualityError, refine
from ledgerline.operators.project import standardize, lineage_columns
from ledgerline.sources import readers as IN
from ledgerline.sources.sinks import write_csv

GOLD_COLUMNS = (
    "sender_account transaction_id event_time receiver_account amount payment_channel location source_system "
    "ingestion_timestamp location_missing Category Type device_hash device_used ip_address timestamp is_fraud "
    "fraud_type time_of_day day_of_week is_fraud_inconsistent avg_amount_last_24h tx_count_last_24h "
    "max_velocity_score mean_velocity_score min_velocity_score avg_geo_anomaly_score avg_spending_deviation_score "
    "row_hash"
).split()


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """A wide CSV with a bad timestamp, a missing sender and untyped fraud."""
    path = str(tmp_path_factory.mktemp("wide") / "wide")
    i = F.col("id")
    text = i.cast("string")
    frame = spark.range(0, 400, 1, 4).select(
        F.concat(F.lit("T"), text).alias("transaction_id"),
        F.when(i == 7, "junk").otherwise(F.concat(F.lit("2024-03-04T"), F.lpad((i % 24).cast("string"), 2, "0"), F.lit(":10:20.123456"))).alias("timestamp"),
        F.when(i != 8, F.concat(F.lit("A"), (i % 10).cast("string"))).alias("sender_account"),
        F.lit("R").alias("receiver_account"),
        (i / 4).cast("double").alias("amount"),
        F.element_at(F.array(F.lit("pay"), F.lit("wire")), (i % 2 + 1).cast("int")).alias("transaction_type"),
        F.lit("shop").alias("merchant_category"),
        F.when(i % 50 != 0, F.concat(F.lit("L"), (i % 30).cast("string"))).alias("location"),
        F.lit("web").alias("device_used"),
        (i % 4 == 0).alias("is_fraud"),
        F.when((i % 4 == 0) & (i % 3 == 0), "x").alias("fraud_type"),
        (i % 7).cast("double").alias("velocity_score"),
        (i % 5).cast("double").alias("geo_anomaly_score"),
        (i % 3).cast("double").alias("spending_deviation_score"),
        F.lit("card").alias("payment_channel"),
        F.lit("10.0.0.1").alias("ip_address"),
        F.md5(text).alias("device_hash"),
    )
    write_csv(frame, path)
    return IN.read_wide_csv(spark, path)


@pytest.fixture(scope="module")
def run(spark, wide, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("run"))
    specs = D.write_raw(D.decompose(wide), f"{root}/raw")
    bronze, status = IN.ingest(spark, specs, f"{root}/bronze")
    silver, alerts = refine(spark, bronze, f"{root}/silver")
    return root, status, bronze, silver, alerts, write_gold(spark, silver, f"{root}/gold")


def test_sources_of_the_decomposition(wide, rows):
    frames = D.decompose(wide)
    assert frames["payments"].columns[:2] == ["tx_id", "event_time"]
    assert frames["merchant"].columns == ["ID", "Category", "Type", "Amount", "Location"]
    assert frames["device"].columns == ["transaction_id", "device", "network"]
    assert frames["customer_behavior"].count() == 10
    bad = frames["fraud_timing"].filter("transaction_id = 'T7'").first()
    assert bad["timestamp"] is None and bad["time_of_day"] == "night" and bad["day_of_week"] is None
    assert tuple(D.unparsed_timestamps(wide).first()) == (1, 1)


def test_ingest_loads_all(run, rows):
    _, status, bronze, *_ = run
    assert rows(status, "source", "status", "row_count") == [
        ("customer_behavior", "loaded", 10),
        ("device", "loaded", 400),
        ("fraud_timing", "loaded", 400),
        ("merchant", "loaded", 400),
        ("payments", "loaded", 400),
    ]


def test_gold_equals_the_direct_computation(run, wide, rows):
    *_, tables = run
    frames = {name: standardize(lineage_columns(df, name)) for name, df in D.decompose(wide).items()}
    direct = to_gold(frames)
    gold = tables[GOLD_TABLE]
    assert gold.columns == direct.columns == GOLD_COLUMNS
    assert gold.count() == 400
    assert rows(gold, "transaction_id", "row_hash") == rows(direct, "transaction_id", "row_hash")
    assert dict(gold.dtypes)["amount"] == "decimal(18,2)"


def test_left_location_wins_over_blanked(run):
    *_, tables = run
    assert tables[GOLD_TABLE].filter("location IS NULL").count() == 8


def test_summaries_and_their_rows(run):
    *_, tables = run
    assert set(tables) == {GOLD_TABLE} | {
        f"fraud_by_{key}{part}" for key in ("category", "type", "location") for part in ("", "_timestamps", "_fraud_types")
    }
    by_type = {r["Type"]: r for r in tables["fraud_by_type"].collect()}
    assert by_type["pay"]["fraud_count"] == 100 and by_type["wire"]["fraud_count"] == 0
    assert by_type["pay"]["dataset_type"] == "fraud_by_type"
    assert by_type["pay"]["timestamps_size"] == tables["fraud_by_type_timestamps"].filter("Type = 'pay'").count()


def test_alerts_of_the_run(run):
    *_, alerts, _ = run
    found = sorted(r["message"] for r in alerts.collect())
    assert found[0] == "Row count mismatch across sources: " + ", ".join(
        f"{s}={n}"
        for s, n in (
            ("payments", 400),
            ("merchant", 400),
            ("device", 400),
            ("customer_behavior", 10),
            ("fraud_timing", 400),
        )
    )
    assert "customer_behavior: 1 sender_accounts missing vs payments" in found
    assert "fraud_timing: fraud_type has 91.50% nulls" in found


def test_hash_is_stable_under_repartition(run, rows):
    _, _, _, silver, _, tables = run
    shuffled = {name: df.repartition(5) for name, df in silver.items()}
    assert rows(to_gold(shuffled), "row_hash") == rows(tables[GOLD_TABLE], "row_hash")


def test_lenient_gold_turns_time_of_day_to_null(run):
    _, _, _, silver, _, _ = run
    lenient = to_gold(silver, strict=False)
    assert lenient.filter("time_of_day IS NOT NULL").count() == 0
    assert lenient.columns == GOLD_COLUMNS


def test_missing_sources_are_skipped(run):
    _, _, _, silver, _, _ = run
    part = to_gold({name: silver[name] for name in ("payments", "fraud_timing")})
    assert "Category" not in part.columns and part.count() == 400
    with pytest.raises(ValueError):
        to_gold({"device": silver["device"]})


def test_a_failing_source_is_an_alert(spark, run, tmp_path):
    _, _, bronze, *_ = run
    broken = bronze["merchant"].withColumn("Category", F.raise_error(F.lit("bad row")).cast("string"))
    silver, alerts = refine(spark, {"merchant": broken, "device": bronze["device"]}, str(tmp_path))
    assert list(silver) == ["device"]
    assert "merchant: processing failed" in [r["message"] for r in alerts.collect()]


def test_refused_alerts_raise(spark, run, tmp_path):
    _, _, bronze, *_ = run
    with pytest.raises(QualityError, match="fraud_type has"):
        refine(spark, {"fraud_timing": bronze["fraud_timing"]}, str(tmp_path), fail_on=["completeness"])


def test_profile_job_and_review(spark, run, tmp_path, rows):
    root, *_ = run
    tables = {name: f"{root}/bronze/{name}" for name in ("payments", "device", "absent")}
    profiles = profile_job(spark, tables, str(tmp_path / "meta"))
    seen = review(profiles)
    assert rows(seen["row_counts"]) == [("device", 400.0), ("payments", 400.0)]
    assert ("payments", "location", "null_pct", 2.0) in rows(seen["null_issues"])
    assert {r["column_name"] for r in seen["struct_columns"].collect()} == {"device", "network"}
