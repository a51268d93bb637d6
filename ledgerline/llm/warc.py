"""Web archives: pages as WARC records, and captures assembled from records.

A capture is written as three records of one WARC/1.1 file: `response` (or
`revisit`, where an earlier page has the same payload), `request` and
`metadata`.  The last two name the first in WARC-Concurrent-To.  Record ids are
derived from content, so a task that runs again writes the same bytes.

Spark's text sink writes the files: the two line ends that close a record are
its row separator, and gzip is its codec, so any Hadoop file system and its
committer work.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches

# Fixed values of the format.
VERSION = b"WARC/1.1"
CLOSE = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "2024-01-01T00:00:00Z"
NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1 digest."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, '/'.join(map(str, parts)))}>"


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without the two line ends that close it."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + CLOSE + block


def one_line(value: str) -> str:
    """A header value: line ends would break the record, so they are escaped."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if value else ""


def capture(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """The three records of a page; `first` is the page it revisits, None for a response."""
    main = record_id(page_id, digest)
    target = [("WARC-Target-URI", one_line(url))] if url else []
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    shared = [*target, ("WARC-Date", CAPTURED), ("WARC-Payload-Digest", f"sha1:{digest}")]
    kind = [("Content-Type", "application/http; msgtype=response")]
    if first is None:
        top = record([("WARC-Type", "response"), ("WARC-Record-ID", main), *shared, *kind], http + payload)
    else:
        of = [("WARC-Refers-To", record_id(first, digest)), ("WARC-Profile", PROFILE)]
        top = record([("WARC-Type", "revisit"), ("WARC-Record-ID", main), *of, *shared, *kind], http)
    beside = [("WARC-Concurrent-To", main), *target, ("WARC-Date", CAPTURED)]
    asked = record(
        [
            ("WARC-Type", "request"),
            ("WARC-Record-ID", record_id(page_id, digest, "request")),
            *beside,
            ("Content-Type", "application/http; msgtype=request"),
        ],
        f"GET {one_line(url or '')} HTTP/1.1\r\nUser-Agent: archive\r\n\r\n".encode(),
    )
    about = record(
        [
            ("WARC-Type", "metadata"),
            ("WARC-Record-ID", record_id(page_id, digest, "metadata")),
            *beside,
            ("Content-Type", "application/warc-fields"),
        ],
        (f"page-id: {page_id}\r\n" if page_id is not None else "").encode(),
    )
    return CLOSE.join((top, asked, about))


def _digested(pages: DataFrame) -> DataFrame:
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("html", pa.string()),
            ("digest", pa.string()),
            ("bytes", pa.int64()),
        ]
    )

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        payloads = [(x.as_py() or "").encode() for x in batch.column(2)]
        more = [pa.array(map(payload_digest, payloads), pa.string()), pa.array(map(len, payloads), pa.int64())]
        yield pa.record_batch([*batch.columns, *more], schema=schema)

    return map_batches(pages.select("page_id", "url", "html"), work, schema)


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, records_per_file: int = 20_000) -> None:
    """Archive every page (`page_id`, `url`, `html`; NULL html is an empty payload).

    Among pages with one payload of at least `least_bytes` bytes, the one with
    the smallest page_id is stored and the others revisit it.  Rows that repeat
    a page_id and its payload are stored alike, as are all pages without an id
    whose payload no page with an id has.  A common payload is one row per task
    in the shuffle that finds its first page; the join back is a plain equi-join,
    which adaptive execution splits under a common payload.
    """
    found = _digested(pages)
    first = (
        _digested(pages)
        .filter(F.col("bytes") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"))
    )
    joined = found.join(first, "digest", "left").select(
        "page_id",
        "url",
        "html",
        "digest",
        F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("first"),
    )
    schema = pa.schema([("value", pa.binary())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = [
            capture(page.as_py(), url.as_py(), (html.as_py() or "").encode(), digest.as_py(), of.as_py())
            for page, url, html, digest, of in zip(*batch.columns)
        ]
        yield pa.record_batch([pa.array(out, pa.binary())], schema=schema)

    (
        map_batches(joined, work, schema)
        .select(F.col("value").cast("string"))
        .write.option("lineSep", CLOSE.decode())
        .option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


def unzipped(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """Pieces of a gzip file, of one member or many; plain data comes as it is."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data:
        member = zlib.decompressobj(31)
        while not member.eof:
            piece = member.decompress(data, step)
            if not piece and not data:
                raise ValueError("the gzip file ends early")
            data = member.unconsumed_tail or member.unused_data
            yield piece


def parse(pieces: Iterator[bytes], step: int = 4) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record, holding one record and a few pieces at a time."""
    held, at = b"", 0
    while True:
        cut = held.find(CLOSE, at)
        end = None
        if cut >= 0:
            first, *lines = held[at:cut].split(b"\r\n")
            if not first.startswith(b"WARC/"):
                raise ValueError(f"no record starts with {first[:40]!r}")
            headers = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines)}
            end = cut + 4 + int(headers["content-length"])
        if end is not None and end + 4 <= len(held):
            yield headers, held[cut + 4 : end]
            at = end + 4
            continue
        more = b"".join(x for _, x in zip(range(step), pieces))
        if not more:
            if held[at:].strip():
                raise ValueError("the last record ends early")
            return
        held, at = held[at:] + more, 0


RECORDS = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("concurrent_to", pa.string()),
        ("refers_to_id", pa.string()),
        ("target_uri", pa.string()),
        ("content_type", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("block", pa.binary()),
    ]
)


def read_warc(spark: SparkSession, folder: str, keep_blocks: bool = True) -> DataFrame:
    """One row per record of the archives of a folder.

    Length and digest of a response's payload are taken from the payload itself,
    and a digest that differs from the header's is an error.  A revisit has no
    payload: both come from its headers.  Without `keep_blocks` the blocks of
    requests and responses are dropped once they have been measured.
    """

    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind, digest, size = headers.get("warc-type"), headers.get("warc-payload-digest"), None
        digest = digest.partition(":")[2] if digest else None
        if kind in ("response", "revisit"):
            head, _, payload = block.partition(CLOSE)
            if kind == "response":
                size = len(payload)
                if payload_digest(payload) != digest:
                    raise ValueError(f"payload and digest differ in {headers.get('warc-record-id')}")
            else:
                lengths = (x.partition(b":")[2] for x in head.split(b"\r\n") if x[:15].lower() == b"content-length:")
                size = int(next(lengths))
        kept = block if keep_blocks or kind not in ("response", "revisit", "request") else None
        uri = headers.get("warc-target-uri")
        for code, sign in (("%0D", "\r"), ("%0A", "\n"), ("%25", "%")):
            uri = uri.replace(code, sign) if uri else uri
        return (
            headers["warc-record-id"],
            kind,
            headers.get("warc-concurrent-to"),
            headers.get("warc-refers-to"),
            uri,
            headers.get("content-type"),
            digest,
            size,
            kept,
        )

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(RECORDS)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, RECORDS)], schema=RECORDS)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for data in batch.column(0):
            rows, size = [], 0
            for headers, block in parse(unzipped(data.as_py())):
                rows.append(row(headers, block))
                size += len(rows[-1][-1] or b"")
                if len(rows) >= 5_000 or size > 8 << 20:
                    yield batch_of(rows)
                    rows, size = [], 0
            yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return map_batches(files.select("content"), work, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, its request and its metadata.

    A record belongs to the capture named in its WARC-Concurrent-To; a response
    or revisit is its capture's own name.  Where a capture was stored n times
    there are n rows.  A capture without a response or revisit still gives a row,
    with NULL there.  The shuffle is on the capture, three records each.
    """
    main = F.col("record_type").isin("response", "revisit")
    whole = F.struct("record_id", "record_type", "target_uri", "content_type", "payload_digest", "payload_bytes",
                     "refers_to_id", "block")
    part = F.struct("record_id", "target_uri", "content_type", "block")

    def of(kind: str):
        return F.first(F.when(F.col("record_type") == kind, part), ignorenulls=True).alias(kind)

    grouped = (
        records.withColumn("capture_id", F.when(main, F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id")))
        .groupBy("capture_id")
        .agg(F.first(F.when(main, whole), ignorenulls=True).alias("capture"), of("request"), of("metadata"), F.count_if(main).alias("n"))
    )
    times = F.explode(F.sequence(F.lit(1), F.greatest(F.col("n"), F.lit(1))))
    return grouped.withColumn("copy", times).drop("n", "copy")


def page_id_of(metadata_block: Column) -> Column:
    """The page id in the fields of a metadata record."""
    return F.regexp_extract(metadata_block.cast("string"), r"(?m)^page-id: (-?\d+)", 1).try_cast("bigint")
