"""Grace hash deduplication: records go to spill files by hash until each bucket's contents fit a table.

A record is a content with the number of its copies and the row that stays.  Three kinds of passes
make few of many:

1. Each task absorbs the copies among its own rows, so the shuffle gets one record per content and
   task (and per `ABSORB_BYTES` of contents), whatever a group's size.
2. Contents that still have many records are absorbed once more, dealt out by hash and salt.
3. Buckets: records are dealt out by a hash that is new at each level.  A bucket's task keeps contents
   in an open-addressing table as long as they fit; a content that comes after that is spilled, and so
   is every copy of it.  What was spilled goes to the next level, until nothing is.

Contents are compared in full; hashes only find the place to look.  Every pass ends in a table in the
shared folder, so a lost executor repeats its own tasks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ledgerline.llm.common import if_small, signed, written

#: Bytes of contents that a task keeps while it absorbs copies, and that a bucket's table keeps.
ABSORB_BYTES, BUCKET_BYTES = 32 << 20, 64 << 20

#: What an entry costs besides its content.
ENTRY_BYTES = 200

#: Records of one content from which on they are absorbed once more before the buckets.
HOT_RECORDS = 1_024

_RECORD = [
    ("rep", pa.int64()),
    ("hash", pa.int64()),
    ("content", pa.binary()),
    ("size", pa.int64()),
    ("n", pa.int64()),
    ("top", pa.int64()),
    ("top_row", pa.int64()),
]
#: A member has `row` and `doc_id` and the record that stands for it; a record has no `row`.
ABSORBED = pa.schema([*_RECORD, ("row", pa.int64()), ("doc_id", pa.int64())])
#: A record without its content is resolved: its group's size, its row that stays and its digest are known.
RESOLVED = pa.schema([*_RECORD, ("sha256", pa.string())])


class ContentTable:
    """Contents by open addressing with linear probing, as long as they fit.

    After one content has been refused all new ones are, so that either every copy of a content
    that comes is found here or none is.
    """

    def __init__(self, most_bytes: int):
        self.most, self.held, self.full = most_bytes, 0, False
        self.slots: list[int] = [-1] * 64
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def place(self, key: int, content: bytes) -> int:
        """The entry that holds this content, made if it is new; -1 if there is no room for it."""
        mask, hashes, contents = len(self.slots) - 1, self.hashes, self.contents
        at = key & mask
        while (entry := self.slots[at]) >= 0:
            if hashes[entry] == key and contents[entry] == content:
                return entry
            at = (at + 1) & mask
        size = len(content) + ENTRY_BYTES
        # The first content is taken at any size, so that each level resolves something.
        self.full = self.full or bool(contents and self.held + size > self.most)
        if self.full:
            return -1
        self.slots[at] = len(contents)
        hashes.append(key)
        contents.append(content)
        self.held += size
        if 2 * len(contents) > len(self.slots):
            self._grow()
        return len(contents) - 1

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, key in enumerate(self.hashes):
            at = key & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


class _Groups:
    """A table of contents with what is known of each one's copies."""

    def __init__(self, most_bytes: int):
        self.table = ContentTable(most_bytes)
        self.reps: list[int] = []
        self.n: list[int] = []
        self.top: list[int | None] = []
        self.top_row: list[int] = []

    def add(self, key: int, content: bytes, rep: int, n: int, top: int | None, top_row: int) -> int:
        entry = self.table.place(key, content)
        if entry < 0:
            return entry
        if entry == len(self.n):
            self.reps.append(rep)
            self.n.append(n)
            self.top.append(top)
            self.top_row.append(top_row)
            return entry
        self.n[entry] += n
        mine = self.top[entry]
        # The largest id stays; of rows that share it, the first one.  A missing id is the least.
        if (top is not None and (mine is None or top > mine)) or (top == mine and top_row < self.top_row[entry]):
            self.top[entry], self.top_row[entry] = top, top_row
        return entry


def content_of(text: bytes | None) -> bytes:
    """What is compared: the text in UTF-8 with A-Z in lower case; a missing one is empty."""
    return (text or b"").lower()


def _absorb(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """(row, doc_id, content, n, top_row) to members, and a record per content and table."""

    def records(groups: _Groups) -> pa.RecordBatch:
        contents = groups.table.contents
        nothing = pa.nulls(len(contents), pa.int64())
        return pa.record_batch(
            [
                pa.array(groups.reps, pa.int64()),
                pa.array(map(signed, groups.table.hashes), pa.int64()),
                pa.array(contents, pa.binary()),
                pa.array(map(len, contents), pa.int64()),
                pa.array(groups.n, pa.int64()),
                pa.array(groups.top, pa.int64()),
                pa.array(groups.top_row, pa.int64()),
                nothing,
                nothing,
            ],
            schema=ABSORBED,
        )

    groups = _Groups(most_bytes)
    for batch in batches:
        rows, ids, n, top_rows = (batch.column(c).to_pylist() for c in ("row", "doc_id", "n", "top_row"))
        reps = []
        for at, value in enumerate(batch.column("content")):
            content = content_of(value.as_py())
            key = xxhash.xxh3_64_intdigest(content)
            entry = groups.add(key, content, rows[at], n[at], ids[at], top_rows[at])
            if entry < 0:
                yield records(groups)
                groups = _Groups(most_bytes)
                entry = groups.add(key, content, rows[at], n[at], ids[at], top_rows[at])
            reps.append(groups.reps[entry])
        members = {"rep": reps, "row": rows, "doc_id": ids}
        yield pa.record_batch(
            [pa.array(members[f.name], f.type) if f.name in members else pa.nulls(len(rows), f.type) for f in ABSORBED],
            schema=ABSORBED,
        )
    if groups.reps:
        yield records(groups)


def _bucket(batches: Iterator[pa.RecordBatch], most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Records of one bucket: spilled as they came, or resolved without their content."""
    groups, reps, entries = _Groups(most_bytes), [], []
    for batch in batches:
        spilled = []
        columns = [batch.column(c).to_pylist() for c in ("rep", "hash", "n", "top", "top_row")]
        for at, (value, rep, key, n, top, top_row) in enumerate(zip(batch.column("content"), *columns)):
            entry = groups.add(key & 0xFFFFFFFFFFFFFFFF, value.as_py(), rep, n, top, top_row)
            if entry < 0:
                spilled.append(at)
            else:
                reps.append(rep)
                entries.append(entry)
        if spilled:
            left = pa.table(batch.select([name for name, _ in _RECORD])).take(spilled).combine_chunks()
            for part in left.append_column("sha256", pa.nulls(len(spilled), pa.string())).cast(RESOLVED).to_batches():
                yield part
    digests = [hashlib.sha256(content).hexdigest() for content in groups.table.contents]
    for start in range(0, len(reps), 10_000):
        mine = entries[start : start + 10_000]
        known = {
            "rep": reps[start : start + 10_000],
            "n": [groups.n[e] for e in mine],
            "top": [groups.top[e] for e in mine],
            "top_row": [groups.top_row[e] for e in mine],
            "sha256": [digests[e] for e in mine],
        }
        yield pa.record_batch(
            [pa.array(known[f.name], f.type) if f.name in known else pa.nulls(len(mine), f.type) for f in RESOLVED],
            schema=RESOLVED,
        )


def _absorbed(rows: DataFrame, most_bytes: int, label: str) -> DataFrame:
    work = partial(_absorb, most_bytes=most_bytes)
    return written(rows.mapInArrow(work, from_arrow_schema(ABSORBED)), label)


def _records(absorbed: DataFrame) -> DataFrame:
    return absorbed.filter("row IS NULL").select(*[name for name, _ in _RECORD])


def _members(absorbed: DataFrame) -> DataFrame:
    return absorbed.filter("row IS NOT NULL").select("rep", "row", "doc_id")


def _resolved(records: DataFrame, bucket_bytes: int) -> DataFrame:
    """(rep, n, top, top_row, sha256) for each record, level by level."""
    least = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, level, found = F.coalesce(F.sum(F.col("size") + ENTRY_BYTES), F.lit(0)), 0, []
    left = records.agg(total).first()[0]
    while True:
        buckets = max(least, -(-2 * left // bucket_bytes), 1)
        dealt = records.repartition(buckets, F.xxhash64(F.lit(level), "hash"))
        work = partial(_bucket, most_bytes=bucket_bytes)
        out = written(dealt.mapInArrow(work, from_arrow_schema(RESOLVED)), f"grace-{level}")
        found.append(out.filter("content IS NULL").select("rep", "n", "top", "top_row", "sha256"))
        records = out.filter("content IS NOT NULL").drop("sha256")
        left = records.agg(total).first()[0]
        if not left:
            return reduce(DataFrame.unionByName, found)
        level += 1


def exact_duplicates(
    docs: DataFrame,
    row: str | None = None,
    absorb_bytes: int = ABSORB_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot_records: int = HOT_RECORDS,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and its `row` and `keep_row`.

    Texts are equal when identical after lower-casing A-Z; a NULL text counts as empty, and an empty
    one as equal to other empty ones.  Of equal texts the row with the largest id stays, a NULL id is
    the least; of rows that repeat that id and the text one stays.  An empty table gives no row.  Only
    `doc_id` and `text` are read, so other columns may have any names.  `row` numbers the rows; the
    argument names a column of the documents that does so already.
    """
    number = F.monotonically_increasing_id() if row is None else F.col(row)
    rows = docs.select(
        number.alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("content")
    )
    first = _absorbed(rows.withColumns({"n": F.lit(1).cast("bigint"), "top_row": F.col("row")}), absorb_bytes, "absorbed")
    records = _records(first)
    hot = written(records.groupBy("hash").agg(F.count(F.lit(1)).alias("many")).filter(F.col("many") >= hot_records), "hot")
    again = None
    if not hot.isEmpty():
        # A salt leaves about as many records to a task as tasks to the records of a content.
        hot = if_small(hot)
        salt = F.pmod(F.xxhash64("rep"), F.ceil(F.sqrt("many")))
        dealt = records.join(hot, "hash").repartition(F.col("hash"), salt).select(
            F.col("rep").alias("row"), F.col("top").alias("doc_id"), "content", "n", "top_row"
        )
        again = _absorbed(dealt, absorb_bytes, "absorbed-again")
        records = records.join(hot, "hash", "left_anti").unionByName(_records(again))
    resolved = _resolved(records, bucket_bytes)
    if again is not None:
        inner = _members(again).select("rep", F.col("row").alias("inner")).join(resolved, "rep")
        resolved = resolved.unionByName(
            inner.filter("inner <> rep").drop("rep").withColumnRenamed("inner", "rep")
        )
    return _members(first).join(resolved, "rep").select(
        "doc_id",
        F.col("top").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("top_row")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
        "row",
        F.col("top_row").alias("keep_row"),
    )


def without_copies(docs: DataFrame, **sizes: int) -> DataFrame:
    """The documents, all their columns, without the rows that do not stay."""
    number = "row" if "row" not in docs.columns else "row_" + "_".join(docs.columns)
    numbered = written(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = exact_duplicates(numbered, number, **sizes)
    kept = found.filter("kept").select(F.col("row").alias(number))
    return numbered.join(kept, number, "left_semi").drop(number)
