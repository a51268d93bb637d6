import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import columns as C
from ledgerline.operators import project as S
from ledgerline.plans import decompose as D


def test_rename_only_what_is_there(spark):
    df = spark.createDataFrame([("T1", 1.0, "x")], "ID string, Amount double, Category string")
    assert S.rename_by_map(df).columns == ["transaction_id", "amount", "Category"]
    assert S.rename_by_map(spark.range(1)).columns == ["id"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("1.005", "1.01"),
        (" 2.5 ", "2.50"),
        ("-0.005", "-0.01"),
        ("abc", None),
        ("1e30", None),
        ("1e3", "1000.00"),
        ("NaN", None),
        ("", None),
        (None, None),
    ],
)
def test_safe_decimal_from_text(spark, text, want):
    df = spark.createDataFrame([(text,)], "v string").select(C.safe_decimal(F.col("v")).cast("string"))
    assert df.first()[0] == want


@pytest.mark.parametrize("value, want", [(1.005, "1.01"), (float("nan"), None), (1e30, None), (2.675, "2.68")])
def test_safe_decimal_from_double(spark, value, want):
    df = spark.createDataFrame([(value,)], "v double").select(C.safe_decimal(F.col("v")).cast("string"))
    assert df.first()[0] == want


def test_cast_columns_leaves_others(spark):
    df = spark.createDataFrame(
        [("2024-01-01 05:00:00", "1.239", "7"), ("no", "x", "8")], "event_time string, amount string, other string"
    )
    got = S.cast_columns(df)
    assert got.dtypes == [("event_time", "timestamp"), ("amount", "decimal(18,2)"), ("other", "string")]
    assert [tuple(map(str, r)) for r in got.collect()] == [
        ("2024-01-01 05:00:00", "1.24", "7"),
        ("None", "None", "8"),
    ]


def test_flatten_and_nest_are_inverse(spark, rows):
    flat = spark.createDataFrame(
        [("T1", "web", "h1", "10.0.0.1"), ("T2", None, None, None)],
        "transaction_id string, device_used string, device_hash string, ip_address string",
    )
    nested = S.nest_device(flat)
    assert nested.columns == ["transaction_id", "device", "network"]
    back = S.flatten_device(nested)
    assert back.columns == ["transaction_id", "device_hash", "device_used", "ip_address"]
    assert rows(back.select(*flat.columns)) == rows(flat)
    assert S.flatten_device(flat).columns == flat.columns


def test_flags_are_three_valued(spark):
    data = [(True, None), (True, "x"), (False, None), (None, None), (None, "x")]
    df = spark.createDataFrame(data, "is_fraud boolean, fraud_type string")
    assert [r[0] for r in S.add_flags(df).select("is_fraud_inconsistent").collect()] == [
        True,
        False,
        False,
        None,
        False,
    ]
    place = spark.createDataFrame([("x",), (None,)], "location string")
    assert [r[1] for r in S.add_flags(place).collect()] == [False, True]


def test_time_of_day_edges(spark):
    hours = {4: "night", 5: "morning", 11: "morning", 12: "afternoon", 17: "afternoon", 18: "night"}
    df = spark.createDataFrame([(f"2024-01-01 {h:02d}:59:59",) for h in hours] + [(None,)], "t string")
    got = [r[0] for r in df.select(C.time_of_day(F.col("t").cast("timestamp"))).collect()]
    assert got == [*hours.values(), "night"]


def test_day_of_week(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS t UNION ALL SELECT NULL")
    assert [r[0] for r in df.select(C.day_of_week(F.col("t"))).collect()] == ["Monday", None]


def test_blanked_share_is_repeatable(spark, rows):
    df = spark.range(20000).select(F.concat(F.lit("T"), F.col("id")).alias("k"), F.lit("x").alias("v"))
    blanked = lambda frame: frame.select("k", C.blank_share(F.col("v"), F.col("k")).alias("v"))
    once, again = rows(blanked(df)), rows(blanked(df.repartition(7)))
    assert once == again
    share = sum(v is None for _, v in once) / len(once)
    assert 0.007 < share < 0.013
    other = rows(df.select("k", C.blank_share(F.col("v"), F.col("k"), seed=1).alias("v")))
    assert other != once


def test_blank_keeps_rows_without_key(spark):
    df = spark.createDataFrame([(None, "x")], "k string, v string")
    assert df.select(C.blank_share(F.col("v"), F.col("k"), 1.0)).first()[0] == "x"


def test_text_of_missing_values(spark):
    df = spark.createDataFrame([(None,), ("a",)], "v string")
    assert [r[0] for r in df.select(C.as_text(F.col("v"))).collect()] == [None, "a"]
    assert [r[0] for r in df.select(C.as_text(F.col("v"), "nan")).collect()] == ["nan", "a"]


def test_unparsed_timestamps_count_both_kinds(spark):
    df = spark.createDataFrame([("2024-01-01",), ("junk",), (None,)], "timestamp string")
    assert tuple(D.unparsed_timestamps(df).first()) == (2, 1)


def test_strict_hash_ignores_order_and_lineage(spark):
    df = spark.createDataFrame([("x", None, "y", "s1")], "a string, b string, c string, source_system string")
    one = S.add_row_hash(df).first()["row_hash"]
    two = S.add_row_hash(df.select("c", F.lit("s2").alias("source_system"), "b", "a")).first()["row_hash"]
    assert one == two == hashlib.sha256(b"1:x-1:y").hexdigest()


def test_strict_hash_keeps_null_places_apart(spark):
    df = spark.createDataFrame([("x", None, "y"), ("x", "y", None)], "a string, b string, c string")
    strict = {r["row_hash"] for r in S.add_row_hash(df).collect()}
    loose = {r["row_hash"] for r in S.add_row_hash(df, strict=False).collect()}
    assert len(strict) == 2
    assert loose == {hashlib.sha256(b"x||y").hexdigest()}


def test_strict_hash_tells_marks_and_separators_from_values(spark):
    data = [("\\N", "x"), (None, "x"), ("a||b", "c"), ("a", "b||c"), ("-", "x"), ("1:x", "")]
    df = spark.createDataFrame(data, "a string, b string")
    assert S.add_row_hash(df).select("row_hash").distinct().count() == len(data)


def test_strict_hash_is_the_same_in_every_zone(spark):
    df = spark.sql("SELECT timestamp_micros(1700000000123456) AS t, array(timestamp_micros(1)) AS a, date'2024-01-01' AS d")
    seen = set()
    try:
        for zone in ("UTC", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.add(S.add_row_hash(df).first()["row_hash"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len(seen) == 1


def test_shares_below_the_resolution_are_refused(spark):
    with pytest.raises(ValueError, match="resolution"):
        C.blank_share(F.col("x"), F.col("k"), 0.00004)


def test_utc_normalize_by_type_or_name(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' AS event_time, 'night' AS time_of_day, 1.239D AS amount"
    )
    by_type = S.utc_normalize(df)
    assert by_type.dtypes == [("event_time", "timestamp"), ("time_of_day", "string"), ("amount", "decimal(18,2)")]
    assert by_type.first()["time_of_day"] == "night"
    assert S.utc_normalize(df, by_name=True).first()["time_of_day"] is None


def test_dataset_tag(spark):
    assert S.dataset_tag(spark.range(1), "x").dtypes[1:] == [
        ("dataset_type", "string"),
        ("profiling_timestamp", "timestamp"),
    ]
