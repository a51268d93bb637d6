"""Byte-true copies, publishing, staged writes and named files."""

import bz2
import gzip
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.plans.publish import publish
from ledgerline.sources import files as FS
from ledgerline.sources import readers as IN
from ledgerline.sources import sinks as OUT


def tree(folder):
    """Every file below a folder by its relative name, without Hadoop's checksums and markers."""
    return {
        str(f.relative_to(folder)): f.read_bytes()
        for f in sorted(folder.rglob("*"))
        if f.is_file() and not f.name.startswith((".", "_"))
    }


ODD = {
    "latin.csv": "id;town\n1;Orléans\n2;Málaga".encode("latin-1"),
    "crlf.csv": b"id;town\r\n1;a\r\n",
    "mark.csv": b"\xef\xbb\xbfid;town\n1;a\n",
    "empty.csv": b"",
    "only end.csv": b"\n",
    "no end.csv": b"id;town",
    "bytes.csv": bytes(range(256)) * 3 + b"\xff",
    "packed.csv.gz": gzip.compress(b"id;town\n1;a\n2;b\n"),
    "packed.csv.bz2": bz2.compress(b"id;town\n1;a\n"),
    "2024/jan/deep.csv": b"id;town\n7;z\n",
}


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    for name, data in ODD.items():
        (root / "pay" / name).parent.mkdir(parents=True, exist_ok=True)
        (root / "pay" / name).write_bytes(data)
    return root


def test_copies_have_the_bytes_and_names(spark, landing, tmp_path):
    assert FS.copy_files(spark, str(landing / "pay"), str(tmp_path / "copy"), text=True, header=True)
    assert tree(tmp_path / "copy") == ODD
    assert not [f for f in tmp_path.iterdir() if f.name.startswith(".parts")]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, "2000")
    yield
    for n, value in before.items():
        spark.conf.set(n, value)


@pytest.mark.parametrize("end", [b"\n", b""])
@pytest.mark.parametrize("mark", [b"\xef\xbb\xbf", b""])
@pytest.mark.parametrize("line_end", [b"\n", b"\r\n"])
def test_long_files_come_in_parts_with_headers(spark, tmp_path, small_splits, end, mark, line_end):
    draw = random.Random(3)
    header = b"id;town"
    lines = [b"%d;%s" % (k, bytes(draw.choice(b"abc\xe9\xff;") for _ in range(draw.randint(0, 90)))) for k in range(400)]
    data = mark + line_end.join([header, *lines]) + end
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "big.csv").write_bytes(data)
    (tmp_path / "in" / "small.csv").write_bytes(b"id;town\n1;x")
    assert FS.copy_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), True, True, whole_bytes=4_000)
    parts = tree(tmp_path / "out")
    assert parts.pop("small.csv") == b"id;town\n1;x"
    assert len(parts) > 5 and all(name.startswith("big-") and name.endswith(".csv") for name in parts)
    first, *later = [parts[name] for name in sorted(parts)]
    top = header + line_end[:-1] + b"\n"
    assert all(part.startswith(top) for part in later)
    assert first + b"".join(part[len(top) :] for part in later) == data


def test_long_packed_file_keeps_codec_and_name(spark, tmp_path):
    data = b"".join(b"%d;\xe9\n" % (k * 7919) for k in range(3000))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "big.csv.gz").write_bytes(gzip.compress(data))
    assert FS.copy_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), True, whole_bytes=500)
    (name, packed), = tree(tmp_path / "out").items()
    assert name == "big.csv.gz" and gzip.decompress(packed) == data


def test_long_files_that_are_no_lines_are_refused(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "in"))
    assert not FS.copy_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), False, whole_bytes=100)
    assert not (tmp_path / "out").exists()


def test_publish_audits_each_file_by_name(spark, landing, tmp_path, rows):
    names = ("latin.csv", "crlf.csv", "empty.csv", "no end.csv", "packed.csv.gz")
    for name in set(ODD) - set(names):
        (landing / "pay" / name).unlink()
    specs = {"pay": IN.SourceSpec("csv", "pay", options={"sep": ";"})}
    audit = publish(spark, str(landing), str(tmp_path / "target"), specs)
    name = F.url_decode(F.regexp_extract("file_path", "[^/]+$", 0)).alias("name")
    assert rows(audit.select(name, "row_count")) == [
        ("crlf.csv", 1),
        ("empty.csv", 0),
        ("latin.csv", 2),
        ("no end.csv", 0),
        ("packed.csv.gz", 2),
    ]
    assert tree(tmp_path / "target" / "pay") == {n: ODD[n] for n in names}


def test_publish_of_files_too_long_for_a_value(spark, tmp_path, rows):
    spark.range(5000).coalesce(1).write.parquet(str(tmp_path / "in" / "mer"))
    specs = {"mer": IN.SourceSpec("parquet", "mer")}
    audit = publish(spark, str(tmp_path / "in"), str(tmp_path / "out"), specs, whole_bytes=100)
    assert rows(audit.groupBy("source").sum("row_count")) == [("mer", 5000)]
    many = {"lines": IN.SourceSpec("json", "lines", "n int", multi_line=True)}
    (tmp_path / "in" / "lines").mkdir()
    (tmp_path / "in" / "lines" / "a.json").write_text('[{"n": 1},\n{"n": 2}]')
    with pytest.raises(ValueError, match="span lines"):
        publish(spark, str(tmp_path / "in"), str(tmp_path / "out"), many, whole_bytes=3)
    audit = publish(spark, str(tmp_path / "in"), str(tmp_path / "out"), many)
    assert rows(audit.groupBy("source").sum("row_count")) == [("lines", 2)]


def test_a_failed_publish_leaves_the_old_target(spark, tmp_path, monkeypatch):
    from ledgerline.plans import publish as P

    (tmp_path / "in" / "pay").mkdir(parents=True)
    (tmp_path / "in" / "pay" / "a.csv").write_text("id\n1\n")
    specs = {"pay": IN.SourceSpec("csv", "pay")}
    publish(spark, str(tmp_path / "in"), str(tmp_path / "out"), specs)

    def broken(spark, source, target, *rest):
        FS.copy_files(spark, source, target, *rest)
        raise OSError("the store is gone")

    monkeypatch.setattr(P, "copy_files", broken)
    (tmp_path / "in" / "pay" / "b.csv").write_text("id\n2\n")
    with pytest.raises(OSError, match="store is gone"):
        publish(spark, str(tmp_path / "in"), str(tmp_path / "out"), specs)
    assert tree(tmp_path / "out" / "pay") == {"a.csv": b"id\n1\n"}
    assert [f.name for f in (tmp_path / "out").iterdir()] == ["pay"]


# Staged writes -----------------------------------------------------------------


def test_a_write_that_fails_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    OUT.write_parquet(spark.range(5), path)
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 90, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        OUT.write_parquet(bad, path)
    assert spark.read.parquet(path).count() == 5
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_a_table_can_be_replaced_by_rows_of_its_own(spark, tmp_path):
    path = str(tmp_path / "t")
    OUT.write_parquet(spark.range(10), path)
    OUT.write_parquet(spark.read.parquet(path).filter("id < 4"), path)
    assert spark.read.parquet(path).count() == 4


def test_a_commit_that_was_cut_off_is_mended(spark, tmp_path):
    path = str(tmp_path / "t")
    OUT.write_parquet(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / ".old-t-abc")  # ended after the first of the two renames
    assert list(IN.read_existing(spark, {"t": path})) == ["t"]
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "t").rename(tmp_path / ".old-t-abd")
    OUT.write_parquet(spark.range(8), path)
    assert spark.read.parquet(path).count() == 8 and [f.name for f in tmp_path.iterdir()] == ["t"]


def test_staged_folders_are_hidden_from_the_folder_above(spark, tmp_path):
    OUT.write_parquet(spark.range(3), str(tmp_path / "all" / "source=a"))
    with FS.replacing(spark, str(tmp_path / "all" / "source=a")) as staged:
        spark.range(50).write.parquet(staged)
        assert spark.read.parquet(str(tmp_path / "all")).count() == 3
    assert spark.read.parquet(str(tmp_path / "all")).count() == 50


def test_named_files(spark, tmp_path):
    data = [("b.csv", 2, "two"), ("a b=1.csv", 1, "x"), ("b.csv", 1, "one"), ("b.csv", -1, "top")]
    rows = spark.createDataFrame(data, "name string, at int, value string").repartition(3)
    FS.write_files(rows, str(tmp_path / "out"))
    assert tree(tmp_path / "out") == {"b.csv": b"top\none\ntwo\n", "a b=1.csv": b"x\n"}
    FS.write_files(rows.limit(0), str(tmp_path / "out"))
    assert tree(tmp_path / "out") == {}


def test_partitions_of_one_write(spark, tmp_path, rows):
    path = str(tmp_path / "m")
    OUT.write_partitions(spark.createDataFrame([("a", 1), ("b", 2)], "source string, n int"), path)
    OUT.write_partitions(spark.createDataFrame([("b", 3), ("c", 4)], "source string, n int"), path)
    assert rows(spark.read.parquet(path), "source", "n") == [("a", 1), ("b", 3), ("c", 4)]


# Parts with schemas of their own ----------------------------------------------


def test_parts_with_other_columns_have_all_of_them(spark, tmp_path, rows):
    spark.sql("SELECT 1 AS id").write.parquet(str(tmp_path / "a"))
    spark.sql("SELECT 2L AS ID, 'x' AS extra, named_struct('p', 1.5F, 'q', array(1)) AS s").write.parquet(str(tmp_path / "b"))
    spark.sql("SELECT 'y' AS extra, named_struct('q', array(2L), 'r', 7) AS s, 3 AS id").write.parquet(str(tmp_path / "c"))
    for order in ("abc", "cba", "bac"):
        df = IN.read_dataset(spark, *[str(tmp_path / x) for x in order])
        assert {n.lower(): k for n, k in df.dtypes}["id"] == "bigint"
        got = df.selectExpr("id", "extra", "s.p", "s.q", "s.r")
        assert rows(got) == [(1, None, None, None, None), (2, "x", 1.5, [1], None), (3, "y", None, [2], 7)]


@pytest.mark.parametrize(
    "one, other, want",
    [
        ("CAST(1 AS TINYINT)", "2", "int"),
        ("1", "CAST(2.5 AS DOUBLE)", "double"),
        ("1.5F", "CAST(2.5 AS DOUBLE)", "double"),
        ("CAST(1.5 AS DECIMAL(4,1))", "CAST(1.25 AS DECIMAL(10,2))", "decimal(10,2)"),
        ("CAST(123.4 AS DECIMAL(4,1))", "CAST(1.255 AS DECIMAL(4,3))", "decimal(6,3)"),
        ("1", "CAST(1.5 AS DECIMAL(4,1))", "decimal(11,1)"),
    ],
)
def test_types_widen_without_a_loss(spark, tmp_path, rows, one, other, want):
    spark.sql(f"SELECT {one} AS v").write.parquet(str(tmp_path / "a"))
    spark.sql(f"SELECT {other} AS v").write.parquet(str(tmp_path / "b"))
    df = IN.read_dataset(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert df.dtypes == [("v", want)]
    both = spark.sql(f"SELECT CAST({one} AS {want}) AS v UNION ALL SELECT CAST({other} AS {want})")
    assert rows(df) == rows(both)


@pytest.mark.parametrize("one, other", [("1", "'1'"), ("TRUE", "1"), ("1L", "CAST(1 AS DOUBLE)"), ("named_struct('p', 1)", "named_struct('p', 'x')")])
def test_types_that_nothing_holds_are_an_error(spark, tmp_path, one, other):
    spark.sql(f"SELECT {one} AS v").write.parquet(str(tmp_path / "a"))
    spark.sql(f"SELECT {other} AS v").write.parquet(str(tmp_path / "b"))
    with pytest.raises(IN.SchemaConflict, match="v"):
        IN.read_dataset(spark, str(tmp_path / "a"), str(tmp_path / "b"))


def test_files_of_one_part_may_differ(spark, tmp_path, rows):
    spark.sql("SELECT 1 AS v").write.parquet(str(tmp_path / "a"))
    spark.sql("SELECT 2L AS v, 'x' AS w").write.mode("append").parquet(str(tmp_path / "a"))
    assert rows(IN.read_dataset(spark, str(tmp_path / "a"))) == [(1, None), (2, "x")]


def test_reassembly_pushes_filters_and_columns_down(spark, tmp_path):
    for name in "ab":
        spark.range(9).selectExpr("id", "id AS other").write.parquet(str(tmp_path / name))
    df = IN.read_dataset(spark, str(tmp_path / "a"), str(tmp_path / "b")).filter("id > 5").select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "GreaterThan(id,5)" in plan and "ReadSchema: struct<id:bigint>" in plan


# Records that do not fit -------------------------------------------------------


def test_malformed_records_are_counted_and_put_aside(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("id,n\nx,1\ny,many\nz\n")
    (tmp_path / "a.json").write_text('{"id": "x"}\n{"id": \n{"id": "z", "n": 3}\n')
    specs = {
        "csv": IN.SourceSpec("csv", str(tmp_path / "a.csv"), "id string, n int"),
        "json": IN.SourceSpec("jsonl", str(tmp_path / "a.json"), "id string, n int"),
        "free": IN.SourceSpec("json", str(tmp_path / "a.json")),
        "strict": IN.SourceSpec("json", str(tmp_path / "a.json"), "id string, n int", options={"mode": "FAILFAST"}),
    }
    root = str(tmp_path / "bronze")
    frames, status = IN.ingest(spark, specs, root)
    assert rows(status, "source", "status", "row_count", "malformed") == [
        ("csv", "loaded", 3, 2),
        ("free", "loaded", 3, 1),
        ("json", "loaded", 3, 1),
        ("strict", "failed", None, None),
    ]
    assert rows(frames["csv"], "id", "n") == [("x", 1), ("y", None), ("z", None)]
    assert all(IN.MALFORMED not in df.columns and "_corrupt_record" not in df.columns for df in frames.values())
    aside = spark.read.parquet(f"{root}/{IN.QUARANTINE}/csv")
    assert rows(aside, IN.MALFORMED, "id", "source_system") == [("y,many", "y", "csv"), ("z", "z", "csv")]
    assert rows(spark.read.parquet(f"{root}/{IN.QUARANTINE}/free"), IN.MALFORMED) == [('{"id": ',)]
    frames, status = IN.ingest(spark, {"csv": specs["csv"]}, root, drop_malformed=True)
    assert rows(status, "row_count", "malformed") == [(1, 2)] and rows(frames["csv"], "id", "n") == [("x", 1)]


def test_quarantine_of_an_earlier_run_goes(spark, tmp_path, rows):
    spec = {"s": IN.SourceSpec("csv", str(tmp_path / "a.csv"), "id string, n int")}
    (tmp_path / "a.csv").write_text("id,n\ny,many\n")
    IN.ingest(spark, spec, str(tmp_path / "b"))
    assert (tmp_path / "b" / IN.QUARANTINE / "s").is_dir()
    (tmp_path / "a.csv").write_text("id,n\ny,2\n")
    _, status = IN.ingest(spark, spec, str(tmp_path / "b"))
    assert rows(status, "row_count", "malformed") == [(1, 0)] and not (tmp_path / "b" / IN.QUARANTINE / "s").exists()


def test_many_renames_list_each_folder_once(spark, tmp_path, monkeypatch):
    """A file costs a rename; a target that is there is an error and stays as it is."""
    calls, at = [], FS.Files._at
    monkeypatch.setattr(FS.Files, "_at", lambda self, path: calls.append(path) or at(self, path))
    names = [f"f{k}" for k in range(600)]
    (tmp_path / "from").mkdir()
    for name in names:
        (tmp_path / "from" / name).write_text(name)
    rows = spark.createDataFrame([(name, k, name) for k, name in enumerate(names[:40])], "name string, at int, value string")
    FS.write_files(rows, str(tmp_path / "lines"))
    assert len(calls) < 40
    assert {f.name: f.read_text() for f in (tmp_path / "lines").glob("f*")} == {n: f"{n}\n" for n in names[:40]}
    moves = [(f"{tmp_path}/from/{n}", f"{tmp_path}/to/{n}") for n in names]
    FS.Files(spark).move_all(moves)
    assert {f.name: f.read_text() for f in (tmp_path / "to").glob("f*")} == {n: n for n in names}
    (tmp_path / "from" / "f1").write_text("new")
    for bad in (moves[1:2], [(moves[1][0], f"{tmp_path}/to/x"), (moves[2][0], f"{tmp_path}/to/x")]):
        with pytest.raises(OSError):
            FS.Files(spark).move_all(bad)
    assert (tmp_path / "to" / "f1").read_text() == "f1"
