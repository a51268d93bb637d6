"""Whole files and folders: byte-true copies made by tasks, and folders replaced in one step.

Tasks move the bytes; the driver only lists, renames and deletes, through Hadoop's file systems.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import partial
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.together import all_together

# File name endings of compressed text, and Spark's name of the codec.
CODECS = {".gz": "gzip", ".bz2": "bzip2", ".deflate": "deflate", ".lz4": "lz4", ".snappy": "snappy"}

#: A file up to this size is one value of one row; longer ones are copied by lines.  Files that have no lines may be longer.
WHOLE_BYTES, BINARY_BYTES = 256 << 20, 1 << 30

#: Renames that one thread does in a row.
RENAMES = 256


class Files:
    """The file systems of a session: what a path holds, renames and deletes."""

    def __init__(self, spark: SparkSession):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._scanner = spark._jvm.java.util.Scanner

    def _at(self, path: str):
        there = self._path(path)
        return there.getFileSystem(self._conf), there

    def exists(self, path: str) -> bool:
        system, there = self._at(path)
        return system.exists(there)

    def qualified(self, path: str) -> str:
        system, there = self._at(path)
        return system.makeQualified(there).toString().rstrip("/")

    def make(self, folder: str) -> None:
        system, there = self._at(folder)
        system.mkdirs(there)

    def first_line(self, path: str) -> bytes:
        """A file's bytes up to the first line feed, without a byte order mark."""
        system, there = self._at(path)
        stream = system.open(there)
        try:
            line = self._scanner(stream, "ISO-8859-1").useDelimiter("\n").next()
        finally:
            stream.close()
        return line.encode("latin-1").removeprefix(b"\xef\xbb\xbf")

    def delete(self, path: str) -> None:
        system, there = self._at(path)
        system.delete(there, True)

    def touch(self, path: str) -> None:
        system, there = self._at(path)
        system.create(there, True).close()

    def names(self, folder: str) -> list[str]:
        system, there = self._at(folder)
        return [f.getPath().getName() for f in system.listStatus(there)] if system.exists(there) else []

    def move(self, source: str, target: str) -> None:
        """Rename; the folder of the target is made, and a target that is there is an error."""
        system, there = self._at(target)
        system.mkdirs(there.getParent())
        if system.exists(there) or not system.rename(self._path(source), there):
            raise OSError(f"{source} could not be renamed to {target}")

    def move_all(self, moves: list[tuple[str, str]]) -> None:
        """Rename (source, target) pairs, some at a time; a target that is there, or comes twice, is an error.

        Each folder is made and listed once, so that a file costs a rename and no more.
        """
        folders = {posixpath.dirname(target) for _, target in moves}
        for folder in folders:
            self.make(folder)
        taken = {f"{folder}/{name}" for folder in folders for name in self.names(folder)}
        targets = [target for _, target in moves]
        if len(taken.union(targets)) < len(taken) + len(targets):
            raise OSError("a target of a rename is there")

        def rename(some: list[tuple[str, str]]) -> None:
            system = self._at(some[0][1])[0]
            for source, target in some:
                if not system.rename(self._path(source), self._path(target)):
                    raise OSError(f"{source} could not be renamed to {target}")

        all_together({str(at): partial(rename, moves[at : at + RENAMES]) for at in range(0, len(moves), RENAMES)})


def _aside(path: str, kind: str, mark: str = "") -> str:
    """A hidden neighbour of a path: readers of the folder above pass over it."""
    folder, name = posixpath.split(path.rstrip("/"))
    return f"{folder}/.{kind}-{name}-{mark}"


def recover(spark: SparkSession, path: str) -> None:
    """Bring a folder back whose replacement ended between its two renames."""
    files, old = Files(spark), _aside(path, "old")
    if files.exists(path):
        return
    folder, prefix = posixpath.split(old)
    for name in sorted(n for n in files.names(folder) if n.startswith(prefix))[:1]:
        files.move(f"{folder}/{name}", path)


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A new folder to write to, which takes the place of `path` when the block has ended.

    Until then `path` is as it was, also for a plan that reads it while the new
    folder is written; after an error it stays.  The commit is two renames, and
    `recover` mends a run that was ended between them.
    """
    files, mark = Files(spark), uuid.uuid4().hex
    recover(spark, path)
    staged, old = _aside(path, "new", mark), _aside(path, "old", mark)
    try:
        yield staged
        there = files.exists(path)
        if there:
            files.move(path, old)
        try:
            files.move(staged, path)
        except Exception:
            if there:
                files.move(old, path)
            raise
        if there:
            files.delete(old)
    except Exception:
        files.delete(staged)
        raise


def contents_of(spark: SparkSession, folder: str) -> DataFrame:
    """Files below a folder that are not empty, a row each; what is not selected is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def all_paths(files: DataFrame) -> list[str]:
    """Paths of all files that a frame reads, the empty ones too, which no scan has a row for."""
    return [re.sub(r"^(\w+):///", r"\1:/", unquote(uri)) for uri in files.inputFiles()]


def _number():
    return F.xxhash64(F.col("_metadata.file_path"))


def write_named(rows: DataFrame, folder: str, end: str = "\n", codec: str = "none") -> None:
    """Write (file, block, at, value): one file below `file=/block=` for each pair, its values in the order of `at`.

    A value is written as its bytes are, in any encoding, and `end`, one byte, after
    it.  The rows of a pair must come from one task; they are sorted there, not shuffled.
    """
    ordered = rows.sortWithinPartitions("file", "block", "at").select("file", "block", F.col("value").cast("string").alias("value"))
    (
        ordered.write.mode("append")
        .partitionBy("file", "block")
        .options(lineSep=end, encoding="ISO-8859-1", compression=codec)
        .text(folder)
    )


def write_files(rows: DataFrame, folder: str, codec: str = "none", known: DataFrame | None = None) -> None:
    """Write (name, at, value): one file of lines for each name in a new folder, in the order of `at`.

    A name's rows meet in one task, so names are for pieces of a size that a task writes.
    `known` has all names, each at least once, where that is less than `rows`.
    """
    spark, staging = rows.sparkSession, _aside(folder, "parts", uuid.uuid4().hex)
    files = Files(spark)
    try:
        named = rows.select(F.xxhash64("name").alias("file"), F.lit(0).alias("block"), "at", "value")
        write_named(named.repartition("file"), staging, codec=codec)
        known = rows if known is None else known
        names = dict(known.select(F.xxhash64("name"), "name").distinct().toLocalIterator())
        with replacing(spark, folder) as staged:
            files.make(staged)
            files.move_all([(path, f"{staged}/{names[f]}") for f, _, path, _ in (_parts(spark, staging) if names else [])])
    finally:
        files.delete(staging)


def write_exactly(rows: DataFrame, folder: str) -> None:
    """Write (file, block, content), no content empty, each as a file with just these bytes.

    The text sink closes a row with a separator of one byte, so contents are
    written by their last byte, a job for each one that occurs; it is cut off,
    and the separator is that byte.
    """
    last = F.expr("hex(substring(content, -1, 1))")
    for row in rows.groupBy(last.alias("last")).count().orderBy("last").collect():
        mine = rows.filter(last == row["last"]).select(
            "file", "block", F.lit(0).alias("at"), F.expr("substring(content, 1, octet_length(content) - 1)").alias("value")
        )
        write_named(mine, folder, end=bytes.fromhex(row["last"]).decode("latin-1"))


def copy_files(
    spark: SparkSession, source: str, target: str, text: bool, header: bool = False, whole_bytes: int = WHOLE_BYTES
) -> bool:
    """Copy all files below `source` into the new folder `target` under their names; False if one is too long for that.

    A file up to `whole_bytes` keeps its bytes, whatever its encoding or codec.
    A longer `text` file is copied by lines, a part per split of the scan, each
    but the first with the first line of the file before it if that is a `header`.
    The parts hold the bytes of the file, its byte order mark and the lack of a
    last line end included.  A longer text file under a codec is one stream, so
    one task copies its lines under the same codec and name and ends the last one.
    Any other longer file makes this return False, and nothing is copied.
    """
    files, staging = Files(spark), _aside(target, "parts", uuid.uuid4().hex)
    base = files.qualified(source) + "/"

    def relative(path: str) -> str:
        return path.removeprefix(base) if path.startswith(base) else posixpath.basename(path)

    contents = contents_of(spark, source)
    found = contents.select("path", "length", _number().alias("file")).collect()  # a row per file, as Spark's own listing
    names = {r["file"]: (relative(r["path"]), r["length"]) for r in found}
    if len(names) < len(found):
        raise ValueError(f"two files below {source} have one number")
    long = {f: (name, n) for f, (name, n) in names.items() if n > whole_bytes}
    if long and not text:
        return False
    files.make(target)
    split = {f: n for f, (name, n) in long.items() if _codec(name) == "none"}
    try:
        if len(long) < len(names):
            # The bounds of the length go to the listing, so longer files are not opened.
            fit = contents.filter(F.col("length") <= whole_bytes)
            write_exactly(fit.select(_number().alias("file"), F.lit(0).cast("bigint").alias("block"), "content"), staging)
        headers = {r["file"]: files.first_line(r["path"]) for r in found if header and r["file"] in split}
        for kind in {_codec(name) for name, _ in long.values()}:
            write_named(_lines(spark, source, kind, whole_bytes, headers), staging, codec=kind)
        parts = _parts(spark, staging) if files.exists(staging) else []
        if split:
            parts = _mended(spark, f"{staging}-mended", parts, split, headers)
        moves = []
        for f, block, path, _ in parts:
            stem, suffix = posixpath.splitext(names[f][0])
            moves.append((path, f"{target}/{stem}-{block:015d}{suffix}" if f in split else f"{target}/{names[f][0]}"))
        files.move_all(moves)
        for path in set(all_paths(contents)) - {r["path"] for r in found}:
            files.touch(f"{target}/{relative(path)}")
    finally:
        files.delete(staging)
        files.delete(f"{staging}-mended")
    return True


def _codec(name: str) -> str:
    return CODECS.get(posixpath.splitext(name)[1].lower(), "none")


def _parts(spark: SparkSession, staging: str) -> list[tuple[int, int, str, int]]:
    """(file, block, path, length) of the files in a staging folder."""
    found = spark.read.format("binaryFile").load(staging)
    return [tuple(r) for r in found.select(F.col("file").cast("bigint"), F.col("block").cast("bigint"), "path", "length").collect()]


def _with_headers(batches: Iterator[pa.RecordBatch], headers: Mapping[int, bytes]) -> Iterator[pa.RecordBatch]:
    """The lines, and the header of its file before the first line of each later block."""
    last = None
    for batch in batches:
        places = list(zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()))
        new = [k for k, place in enumerate(places) if place != (places[k - 1] if k else last) and place[1] and place[0] in headers]
        last = places[-1] if places else last
        yield batch
        if new:
            first = batch.take(pa.array(new))
            lines = pa.array([headers[f] for f in first.column("file").to_pylist()], pa.binary())
            before = pa.array([at - 1 for at in first.column("at").to_pylist()], pa.int64())
            yield pa.record_batch([first.column("file"), first.column("block"), before, lines], schema=batch.schema)


def _lines(spark: SparkSession, source: str, codec: str, whole_bytes: int, headers: Mapping[int, bytes]) -> DataFrame:
    """(file, block, at, value) of the long files under a codec; a block is a split of the scan.

    Only the line feed ends a line, so a carriage return stays with its line.
    """
    lines = spark.read.options(lineSep="\n", recursiveFileLookup=True).text(source)
    ending = F.lower(F.regexp_extract(F.col("_metadata.file_name"), r"(\.[^.]*)$", 1))
    wanted = [suffix for suffix, kind in CODECS.items() if kind == codec]
    chosen = ending.isin(wanted) if wanted else ~ending.isin(list(CODECS))
    lines = lines.filter((F.col("_metadata.file_size") > whole_bytes) & chosen).select(
        _number().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        (F.monotonically_increasing_id() * 2 + 1).alias("at"),
        F.col("value").cast("binary").alias("value"),
    )
    if codec != "none" or not headers:
        return lines
    return lines.mapInArrow(partial(_with_headers, headers=headers), lines.schema)


def _mended(
    spark: SparkSession, staging: str, parts: list[tuple[int, int, str, int]], split: Mapping[int, int], headers: Mapping[int, bytes]
) -> list[tuple[int, int, str, int]]:
    """The parts, those replaced that scan and sink could not keep: a byte order mark is skipped, a last line is always ended.

    Lengths tell: what a file's parts have beyond its length and the headers is 1
    for an added line end and -3 for a lost mark.
    """
    mends = []
    for f, length in split.items():
        mine = sorted((block, path, n) for g, block, path, n in parts if g == f)
        more = sum(n for _, _, n in mine) - length - (len(mine) - 1) * (len(headers[f]) + 1 if f in headers else 0)
        marked, ended = more < 0, more in (1, -2)
        if more != ended - 3 * marked:
            raise OSError(f"parts of {f} have {more} bytes too many")
        ends = {}
        if marked:
            ends[mine[0][0]] = (mine[0][1], True, False)
        if ended:
            block, path, _ = mine[-1]
            ends[block] = (path, ends.get(block, (None, False))[1], True)
        mends += [(f, block, *end) for block, end in ends.items()]
    if not mends:
        return parts
    plan = spark.createDataFrame(mends, "file bigint, block bigint, path string, marked boolean, ended boolean")
    # At most two parts of a long file, each as long as a split of the scan.
    contents = spark.read.format("binaryFile").load([path for _, _, path, _, _ in mends]).select("path", "content")
    kept = "substring(content, 1, octet_length(content) - CAST(ended AS INT))"
    whole = F.expr(f"CASE WHEN marked THEN concat(X'EFBBBF', {kept}) ELSE {kept} END")
    write_exactly(contents.join(F.broadcast(plan), "path").select("file", "block", whole.alias("content")), staging)
    mended = _parts(spark, staging)
    done = {(f, block) for f, block, _, _ in mended}
    return [p for p in parts if p[:2] not in done] + mended
