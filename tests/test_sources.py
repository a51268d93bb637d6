import json

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.plans.publish import audit_totals, publish
from ledgerline.sources import readers as IN
from ledgerline.sources import sinks as OUT
from ledgerline.sources.scratch import scratch_folder


def test_short_ids_stay_text_with_a_schema(spark, tmp_path, rows):
    path = tmp_path / "payments.csv"
    path.write_text(
        "tx_id,event_time,sender_account,receiver_account,amount,payment_channel,location\n"
        "T1,2024-01-02T03:04:05.678901Z,A,B,1.50,card,\n"
    )
    df = IN.read_source(spark, IN.SourceSpec("CSV", str(path), schemas.PAYMENTS_SCHEMA))
    got = rows(df.withColumn("event_time", F.col("event_time").cast("string")))
    assert got == [("T1", "2024-01-02 03:04:05.678901", "A", "B", 1.5, "card", None)]


def test_csv_without_schema_infers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("name,n\nx,1\ny,2\n")
    assert IN.read_source(spark, IN.SourceSpec("csv", str(path))).dtypes == [("name", "string"), ("n", "int")]


def test_csv_header_must_fit_the_schema(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("sender_account,tx_id\nA,T1\n")
    with pytest.raises(Exception):
        IN.read_source(spark, IN.SourceSpec("csv", str(path), schemas.PAYMENTS_SCHEMA)).collect()


def test_json_lines_and_multiline(spark, tmp_path, rows):
    lines, whole = tmp_path / "a.jsonl", tmp_path / "b.json"
    records = [{"transaction_id": f"T{i}", "device": {"device_used": "web", "device_hash": "h"}} for i in range(3)]
    lines.write_text("\n".join(json.dumps(r) for r in records))
    whole.write_text(json.dumps(records, indent=2))
    by_line = IN.read_source(spark, IN.SourceSpec("jsonl", str(lines)))
    at_once = IN.read_source(spark, IN.SourceSpec("json", str(whole), multi_line=True))
    assert rows(by_line, "transaction_id") == rows(at_once, "transaction_id") == [("T0",), ("T1",), ("T2",)]
    assert dict(by_line.dtypes)["device"] == "struct<device_hash:string,device_used:string>"


def test_any_other_format_goes_to_the_reader(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    df.write.orc(str(tmp_path / "orc"))
    (tmp_path / "t.txt").write_text("one\ntwo\n")
    assert rows(IN.read_source(spark, IN.SourceSpec("ORC", str(tmp_path / "orc")))) == [(1, "a")]
    assert rows(IN.read_source(spark, IN.SourceSpec("text", str(tmp_path / "t.txt")))) == [("one",), ("two",)]


def test_ingest_isolates_failures_and_counts(spark, tmp_path, rows):
    good, empty = str(tmp_path / "good"), str(tmp_path / "empty")
    frame = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    frame.write.parquet(good)
    frame.limit(0).write.parquet(empty)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    specs = {
        "bad": IN.SourceSpec("parquet", str(tmp_path / "bad")),
        "empty": IN.SourceSpec("parquet", empty),
        "gone": IN.SourceSpec("parquet", str(tmp_path / "gone")),
        "good": IN.SourceSpec("parquet", good),
    }
    frames, status = IN.ingest(spark, specs, str(tmp_path / "bronze"))
    assert list(frames) == ["good"]
    assert rows(status, "source", "status", "row_count") == [
        ("bad", "failed", None),
        ("empty", "empty", 0),
        ("gone", "missing", None),
        ("good", "loaded", 2),
    ]
    assert rows(frames["good"], "id", "source_system") == [("a", "good"), ("b", "good")]
    assert dict(frames["good"].dtypes)["ingestion_timestamp"] == "timestamp"
    lazy, status = IN.ingest(spark, {"good": specs["good"]})
    assert rows(status, "row_count") == [(None,)] and lazy["good"].count() == 2


def test_plain_timestamps_become_zoned(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' AS t").write.parquet(str(tmp_path / "p"))
    df = IN.extract(spark, "s", IN.SourceSpec("parquet", str(tmp_path / "p")))
    assert dict(df.dtypes)["t"] == "timestamp"


def test_missing_tables_are_left_out(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    found = IN.read_existing(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")})
    assert list(found) == ["a"]


def test_parts_are_put_together(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a"))
    spark.range(3).write.parquet(str(tmp_path / "b"))
    (tmp_path / "a" / "_zero.parquet").write_bytes(b"")
    assert IN.read_dataset(spark, str(tmp_path / "a"), str(tmp_path / "b")).count() == 5


def test_parquet_overwrite_and_layout(spark, tmp_path):
    path = str(tmp_path / "t")
    OUT.write_parquet(spark.range(100), path)
    OUT.write_parquet(spark.range(10), path, files=1)
    assert spark.read.parquet(path).count() == 10
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1
    OUT.write_parquet(spark.range(10).coalesce(1), path, max_records_per_file=4)
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 3


def test_partitioned_write_replaces_only_what_it_holds(spark, tmp_path, rows):
    path = str(tmp_path / "m")
    for source, n in (("a", 1), ("b", 2), ("b", 3)):
        OUT.write_partition(spark.createDataFrame([(source, n)], "source string, n int"), path, source)
    assert (tmp_path / "m" / "source=a").is_dir()
    assert rows(spark.read.parquet(path), "source", "n") == [("a", 1), ("b", 3)]


def test_millisecond_sink_skips_empty(spark, tmp_path, rows):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 10:00:00.123456' AS timestamp")
    assert OUT.write_parquet_ms(df, str(tmp_path / "t"))
    got = spark.read.parquet(str(tmp_path / "t")).select(F.col("timestamp").cast("string"))
    assert rows(got) == [("2024-01-01 10:00:00.123",)]
    assert not OUT.write_parquet_ms(df.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_publish_replaces_audits_and_skips(spark, tmp_path, rows):
    landing, target = tmp_path / "landing", tmp_path / "target"
    (landing / "pay").mkdir(parents=True)
    (landing / "pay" / "p.csv").write_text("id,amount\nT1,1.50\nT2,2.00\n")
    spark.range(3).write.parquet(str(landing / "mer"))
    specs = {
        "pay": IN.SourceSpec("csv", "pay"),
        "mer": IN.SourceSpec("parquet", "mer"),
        "gone": IN.SourceSpec("parquet", "gone"),
    }
    for _ in range(2):
        audit = publish(spark, str(landing), str(target), specs)
    assert rows(audit.groupBy("source").sum("row_count")) == [("mer", 3), ("pay", 2)]
    copied = spark.read.option("header", True).csv(str(target / "pay"))
    assert rows(copied) == [("T1", "1.50"), ("T2", "2.00")]
    assert publish(spark, str(landing), str(target), {"gone": specs["gone"]}).count() == 0


def test_publish_keeps_text_files_as_they_are(spark, tmp_path, rows):
    landing, target = tmp_path / "landing", tmp_path / "target"
    files = {
        "dev/a.json": '{"id": "1", "os": "x", "extra": {"n": 1}}\n{"id": "2"}\n',
        "pay/a.csv": "id;amount\nT1;1,50\n",
        "pay/b.csv": "id;amount\n",
    }
    for name, text in files.items():
        (landing / name).parent.mkdir(parents=True, exist_ok=True)
        (landing / name).write_text(text)
    specs = {
        "dev": IN.SourceSpec("jsonl", "dev", "id string"),
        "pay": IN.SourceSpec("csv", "pay", options={"sep": ";"}),
    }
    audit = publish(spark, str(landing), str(target), specs)
    for folder in ("dev", "pay"):
        copied = {f"{folder}/{f.name}": f.read_text() for f in (target / folder).glob("[a-z]*")}
        assert copied == {name: text for name, text in files.items() if name.startswith(folder)}
    assert rows(audit, "source", "row_count") == [("dev", 2), ("pay", 0), ("pay", 1)]
    assert rows(audit_totals(audit)) == [("dev", 1, 2), ("pay", 2, 1)]


def test_scratch_follows_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    spark.conf.set("spark.checkpoint.dir", str(tmp_path)) if before is None else None
    folder = scratch_folder(spark, "x")
    assert folder.startswith((before or str(tmp_path)).rstrip("/") + "/x-")
    assert folder != scratch_folder(spark, "x")
