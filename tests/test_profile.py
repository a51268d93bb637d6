from pyspark.sql import functions as F

from ledgerline.operators import profile as P


def mixed(spark):
    return spark.sql(
        """
        SELECT 'a' s, 1 i, 0.0D d, CAST(1.5 AS DECIMAL(10,2)) m, true b, TIMESTAMP '2024-01-01 00:00:00' t,
               X'00FF' bin, named_struct('x', 'a', 'y', 1) st, array(1, 2) arr, DATE '1969-12-31' dt,
               CAST(12345678901234567890.5 AS DECIMAL(38,10)) big, TIMESTAMP_NTZ '2024-01-01 00:00:00.000001' ntz, 1.5F f
        UNION ALL SELECT 'a', NULL, -0.0D, 1.50, false, NULL, X'00FE', named_struct('x', CAST(NULL AS STRING), 'y', 1), array(),
               DATE '1969-12-31', 12345678901234567890.5, TIMESTAMP_NTZ '2024-01-01 00:00:00.000002', float('-0.0')
        UNION ALL SELECT NULL, 1, double('NaN'), NULL, true, TIMESTAMP '2024-01-01 00:00:00', NULL, NULL, NULL, NULL, NULL, NULL, 0.0F
        UNION ALL SELECT '', 2, double('NaN'), 1.5, NULL, NULL, X'00FF', named_struct('x', 'a', 'y', 1), array(1, 2),
               DATE '2024-01-01', 0, TIMESTAMP_NTZ '2024-01-01 00:00:00.000002', NULL
        """
    )


def test_distinct_counts_equal_one_column_at_a_time(spark):
    df = mixed(spark)
    got = {df.columns[r["at"]]: r for r in P.column_metrics({"t": df}).collect()}
    assert len(got) == len(df.columns)
    for name in df.columns:
        assert got[name]["distinct_count"] == df.select(name).distinct().count(), name
        assert got[name]["null_count"] == df.filter(F.col(name).isNull()).count(), name
        assert got[name]["row_count"] == 4


def test_profile_layout(spark, rows):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",)], "k string")
    got = P.profile(df, "src")
    assert got.columns == [
        "source",
        "column_name",
        "metric",
        "metric_value",
        "data_type",
        "ingestion_timestamp",
    ]
    assert rows(got, "metric", "metric_value") == [
        ("distinct_count", 3.0),
        ("null_count", 1.0),
        ("null_pct", 25.0),
        ("row_count", 4.0),
    ]


def test_profile_of_an_empty_table(spark, rows):
    got = P.profile(spark.createDataFrame([], "a int, b struct<c:int>"), "e")
    assert got.count() == 8
    assert {r[0] for r in rows(got, "metric_value")} == {0.0}
    assert rows(got.filter("metric = 'row_count'"), "column_name", "data_type") == [("a", "int"), ("b", "struct<c:int>")]


def test_one_scan_per_source_one_pair_shuffle(spark, tmp_path):
    spark.range(10).selectExpr("id AS a", "id AS b", "id AS c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = P.column_metrics({"x": df, "y": df})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning(at") == 2


def test_review(spark, rows):
    frames = {
        "p": spark.createDataFrame([("a", None), ("b", None), (None, 1)], "k string, n int"),
        "q": spark.createDataFrame([((1,),)], "st struct<c:int>"),
    }
    profiles = P.profile_all(frames)
    assert rows(P.columns_per_source(profiles)) == [("p", ["k", "n"]), ("q", ["st"])]
    assert rows(P.column_names(profiles)) == [("k",), ("n",), ("st",)]
    assert rows(P.data_types(profiles)) == [("int",), ("string",), ("struct<c:int>",)]
    assert rows(P.struct_columns(profiles), "column_name", "metric")[0] == ("st", "distinct_count")
    assert rows(P.row_counts_by_source(profiles)) == [("p", 3.0), ("q", 1.0)]
    assert [tuple(r) for r in P.null_issues(profiles).collect()] == [
        ("p", "k", "null_count", 1.0),
        ("p", "k", "null_pct", 33.3),
        ("p", "n", "null_count", 2.0),
        ("p", "n", "null_pct", 66.7),
    ]


def test_null_issue_rounding_is_half_even(spark):
    df = spark.createDataFrame(
        [("s", "c", "null_pct", 0.25), ("s", "d", "null_pct", 0.35)],
        "source string, column_name string, metric string, metric_value double",
    )
    assert [r["metric_value"] for r in P.null_issues(df).collect()] == [0.2, 0.4]


def test_long_values_travel_as_digests(spark):
    long = "x" * 500
    df = spark.createDataFrame(
        [("a" * 16,), ("a" * 17,), (long,), (long,), (long + "y",), ("",), (None,)], "k string"
    ).select("k", F.col("k").cast("binary").alias("b"), F.struct("k").alias("s"))
    got = {r["at"]: r for r in P.column_metrics({"t": df}).collect()}
    assert [got[at]["distinct_count"] for at in range(3)] == [6, 6, 6]
    assert [got[at]["null_count"] for at in range(3)] == [1, 1, 0]
    pairs = df.selectExpr(P._slots(df.schema["k"])[0] + " AS v")
    assert pairs.selectExpr("max(octet_length(v))").first()[0] == P.SHORT + 1
