"""Token ids as length-delimited binary records, with a separate offset index.

File format, all numbers little-endian:

    uint64 length of the payload | uint32 masked CRC of those 8 bytes
    payload | uint32 masked CRC of the payload | one byte 0x0A

The payload is one sequence: a byte that is 1 if a document id follows (0: the id
is NULL), a byte with the width of a token id, the int64 document id, and the
ids.  Ids take two bytes where the vocabulary fits, else four.  The closing byte
is the separator that Spark's text sink puts after each row, so Spark's own
committer writes the files: any Hadoop file system works, and a task that runs
again leaves one copy.

Rows are written in ascending document id (NULL first); the order of the files
by part number is the order of the documents.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import map_batches, written

END = b"\n"
HEAD = struct.Struct("<QI")
BODY = struct.Struct("<BBq")
MASK = 0xA282EAD8
#: Words whose ids a worker remembers, and bytes of them; beyond either it keeps those of the texts at hand alone.
REMEMBERED, REMEMBERED_BYTES = 400_000, 32 << 20


def masked(data: bytes) -> int:
    """CRC-32, rotated and shifted, so that a CRC over data that holds CRCs stays useful."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload))))


def frames(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and payload of every frame; a damaged file is an error."""
    at, view = 0, memoryview(data)
    while at < len(data):
        length, crc = HEAD.unpack_from(data, at)
        if masked(data[at : at + 8]) != crc:
            raise ValueError(f"damaged length at byte {at}")
        start, end = at + HEAD.size, at + HEAD.size + length
        payload = bytes(view[start:end])
        if masked(payload) != struct.unpack_from("<I", data, end)[0] or data[end + 4 : end + 5] != END:
            raise ValueError(f"damaged payload at byte {start}")
        yield at, end + 5 - at, payload
        at = end + 5


def payload_of(doc_id: int | None, ids: np.ndarray) -> bytes:
    return BODY.pack(doc_id is not None, ids.itemsize, doc_id or 0) + ids.tobytes()


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    known, width, doc_id = BODY.unpack_from(payload)
    return doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=BODY.size)


#: What words hold that may have another lower case or other pieces in another version of Unicode than the library's.
HARD = "[^!-~\xa1-\xac\xae-\u012f]"


def _lines(words: pa.Array) -> str:
    """Words as lines of one text."""
    offsets = pa.array([0, len(words)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words), "\n")[0].as_py()


def byte_signs() -> dict[str, int]:
    """The printable stand-ins for bytes that byte-level vocabularies use."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class WordEncoder:
    """Ids of texts by the tokenizers library, remembered by white-space word.

    For tokenizers that split at white space and drop it, the ids of a text are
    those of its words in turn.  Words are cut at ASCII white space only; a piece
    that holds other white space goes to the library as it stands.  New words
    reach the library as one text, a special token between each two.  Texts are
    Arrow columns: their words are told apart, looked up among those remembered
    and put together again without a Python object for each.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        added = self.library.get_added_tokens_decoder()
        self.special = [str(t) for t in added.values()]
        self.between, self.between_id = next(((str(t), at) for at, t in added.items() if t.special), ("", -1))
        self.merges = None
        self._read_merges(path)
        self.known, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def _read_merges(self, path: str) -> None:
        """A rank-merging encoder with the same vocabulary, where the file is of the kind it can stand for.

        The sign \\x01 behind a piece stands for the suffix that ends words: it
        merges with the last byte before anything else does.  The tests hold the
        ids against the library's.
        """
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        suffix = spec["model"].get("end_of_word_suffix")
        normal = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", ())]
        cut = [x["type"] for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", ())]
        if not suffix or normal != ["NFC", "Replace", "Lowercase"] or cut != ["Split", "ByteLevel"]:
            return
        byte = byte_signs()
        added = {x["content"] for x in spec["added_tokens"]}
        ranks = {}
        for token, at in spec["model"]["vocab"].items():
            if token not in added:
                ends = token.endswith(suffix) and token != suffix
                ranks[bytes(byte[c] for c in token.removesuffix(suffix if ends else ""))  + b"\x01" * ends] = at
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.merges = tiktoken.Encoding("words", pat_str=r"[^\x01\n]+\x01|\n", mergeable_ranks=ranks, special_tokens={})
        self.line_id = ranks[b"\n"]

    def _by_library(self, words: list[str]) -> pa.Array:
        """The ids of each word, as bytes."""
        mark = self.between
        alone = [w for w in words if not mark or mark in w]
        joined = [w for w in words if mark and mark not in w] if alone else words
        out = {w: np.array(self.library.encode(w, add_special_tokens=False).ids, self.kind).tobytes() for w in alone}
        if joined:
            (coded,) = self.library.encode_batch_fast([mark.join(joined)], add_special_tokens=False)
            out.update(zip(joined, self._cut(len(joined), np.array(coded.ids, self.kind), self.between_id).to_pylist()))
        return pa.array([out[w] for w in words], pa.large_binary())

    def _cut(self, words: int, ids: np.ndarray, between: int) -> pa.Array:
        """The ids of each of some words that were encoded with `between` between them."""
        apart = ids == between
        ends = np.flatnonzero(apart)
        if len(ends) != words - 1:
            raise ValueError(f"{len(ends) + 1} words were encoded, not {words}")
        ends = np.concatenate([[0], ends - np.arange(len(ends)), [len(ids) - len(ends)]]).astype(np.int64)
        return pa.Array.from_buffers(
            pa.large_binary(), words, [None, pa.py_buffer(ends * self.kind.itemsize), pa.py_buffer(ids[~apart].astype(self.kind))]
        )

    def _coded(self, words: pa.Array) -> pa.Array:
        """The ids of each of some different words."""
        if self.merges is None or not len(words):
            return self._by_library(words.to_pylist())
        hard = pc.match_substring_regex(words, HARD)
        whole = _lines(words)
        # Few texts name a special token, so words are looked at one by one only then.
        for name in [x for x in self.special if x in whole]:
            hard = pc.or_(hard, pc.match_substring(words, name))
        rest = words.filter(hard)
        if not len(rest):
            return self._by_merges(whole, len(words))
        easy = words.filter(pc.invert(hard))
        parts = pa.concat_arrays([self._by_library(rest.to_pylist()), self._by_merges(_lines(easy), len(easy))])
        is_hard, at = hard.to_numpy(zero_copy_only=False), np.empty(len(words), np.int64)
        at[is_hard], at[~is_hard] = np.arange(len(rest)), np.arange(len(rest), len(words))
        return parts.take(pa.array(at))

    def _by_merges(self, lines: str, words: int) -> pa.Array:
        if not words:
            return pa.array([], pa.large_binary())
        ids = self.merges.encode_to_numpy(self.pieces.sub("\\g<0>\x01", lines.lower()), disallowed_special=())
        return self._cut(words, ids, self.line_id)

    def _ids_of(self, words: pa.Array) -> pa.Array:
        """The ids of each of some different words, most of them remembered; those are remembered too."""
        place = pc.index_in(words, value_set=self.known)
        unknown = pc.is_null(place)
        new = words.filter(unknown)
        at = pc.fill_null(place, 0).to_numpy().astype(np.int64)
        at[unknown.to_numpy(zero_copy_only=False)] = len(self.known) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, new])
        self.ids = pa.concat_arrays([self.ids, self._coded(new)])
        found = self.ids.take(pa.array(at))
        if self._too_many():
            self.known, self.ids = words, found
            if self._too_many():
                self.known, self.ids = words[:0].take(pa.array([], pa.int64())), found[:0].take(pa.array([], pa.int64()))
        return found

    def _too_many(self) -> bool:
        return len(self.known) > REMEMBERED or self.known.nbytes + self.ids.nbytes > REMEMBERED_BYTES

    def many(self, listed: pa.Array | list[str | None], end_id: int | None) -> Iterator[np.ndarray]:
        """Ids of each text, with `end_id` behind them if given; a missing text is empty."""
        column = listed if isinstance(listed, pa.Array) else pa.array(listed, pa.string())
        split = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        ends = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy(), dtype=np.int64)])
        words = split.flatten().dictionary_encode()
        ids = self._ids_of(words.dictionary).take(words.indices)
        # Where the ids of each word end, so where those of each text do.
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset) if len(ids) else np.zeros(1, np.int64)
        flat = np.frombuffer(ids.buffers()[2] or b"", self.kind)
        close = np.array([] if end_id is None else [end_id], self.kind)
        cuts = (at[ends] // self.kind.itemsize).tolist()
        for start, end in zip(cuts, cuts[1:]):
            yield np.concatenate([flat[start:end], close])


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One per worker process, whatever the number of its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def write_records(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = None,
    files: int | None = None,
    records_per_file: int = 20_000,
) -> None:
    """Encode every document and write the frames in ascending `doc_id`.

    A NULL text is empty.  Repeated ids keep all their rows, in any order among
    themselves; an empty table gives a folder without frames.  Other columns are
    not looked at.  The range shuffle carries the texts once; a task encodes its
    documents in portions while it writes, so memory does not grow with the file.
    """
    files = files or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, coded = batch.column(0).to_pylist(), encoder(tokenizer).many(batch.column(1), end_id)
        out = [frame(payload_of(*row)) for row in zip(ids, coded, strict=True)]
        yield pa.record_batch([pa.array(out, pa.binary())], ["frame"])

    ordered = docs.select("doc_id", "text").repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id")
    coded = map_batches(ordered, work, pa.schema([("frame", pa.binary())]))
    (
        coded.select(F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", END.decode())
        .option("maxRecordsPerFile", records_per_file)
        .text(folder)
    )


def file_number(path: str) -> int:
    """Order of a part file: its part number, then its number within the task."""
    part, chunk = re.search(r"part-(\d+)-.*-c(\d+)\.", path).groups()
    return int(part) << 24 | int(chunk)


SCANNED = pa.schema(
    [
        ("file", pa.string()),
        ("file_number", pa.int64()),
        ("frame_offset", pa.int64()),
        ("frame_length", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("start_in_file", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def scan_records(spark: SparkSession, folder: str) -> DataFrame:
    """One row per frame, read from the files: place, document, ids before it in its file, CRC of its ids."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path, data in zip(batch.column(0), batch.column(1)):
            name, rows, before = path.as_py(), [], 0
            for at, size, payload in frames(data.as_py()):
                doc_id, ids = unpack(payload)
                crc = zlib.crc32(ids.astype("<u4").tobytes())
                rows.append((name, file_number(name), at, size, doc_id, len(ids), before, crc))
                before += len(ids)
            columns = list(zip(*rows)) or [()] * len(SCANNED)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, SCANNED)], schema=SCANNED)

    return map_batches(_files(spark, folder), work, SCANNED)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "part-*")
        .load(folder)
        .select("path", "content")
    )


def write_index(spark: SparkSession, folder: str, index: str) -> DataFrame:
    """The offset index as a table of its own: where each document's frame lies, and its checksum."""
    scan_records(spark, folder).write.parquet(index)
    return spark.read.parquet(index)


def token_starts(index: DataFrame) -> DataFrame:
    """Ids of all documents before each one.  Only file totals meet in one task, one row per file."""
    totals = index.groupBy("file_number").agg(F.sum("n_tokens").alias("n"))
    before = totals.select(
        "file_number",
        (F.sum("n").over(Window.orderBy("file_number")) - F.col("n")).alias("before"),
    )
    return index.join(before, "file_number").withColumn("start", F.col("before") + F.col("start_in_file"))


def read_shuffled(spark: SparkSession, folder: str, index: DataFrame, seed: int) -> DataFrame:
    """Documents with their ids in a seeded random order, read at the offsets of the index.

    Each file is opened once; of it only the frames the index names are decoded,
    so a filtered index reads a sample.  The order follows a hash of seed and place.
    """
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("place", pa.string())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for path, data, places in zip(*batch.columns):
            raw, rows = data.as_py(), []
            for at, size in ((p["frame_offset"], p["frame_length"]) for p in places.as_py()):
                ((_, _, payload),) = frames(raw[at : at + size])
                doc_id, ids = unpack(payload)
                rows.append((doc_id, ids.astype(np.int32), f"{path.as_py()}:{at}"))
            columns = list(zip(*rows)) or [()] * len(out)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    # Frames of one file are bounded by `records_per_file`.
    places = index.groupBy(F.col("file").alias("path")).agg(
        F.collect_list(F.struct("frame_offset", "frame_length")).alias("places")
    )
    order = F.xxhash64(F.lit(seed), "place")
    found = map_batches(_files(spark, folder).join(places, "path"), work, out)
    return found.withColumn("at", order).orderBy("at").drop("at", "place")


def written_index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of a folder, written below the shared folder."""
    return written(scan_records(spark, folder), "record-index")
