"""Byte-level BPE with reuse: chunks that several documents share are encoded once.

A rolling hash over the UTF-8 bytes of a text sets its cut points, so equal
passages give equal chunks wherever they lie.  Chunks found in more than one
document are encoded once, all together; the rest of a text is encoded where the
text is.  At the joins the ids of a chunk do not simply continue those of its
neighbour, so the text around a join is encoded anew, in a window that widens on
both sides until it begins and ends at a sure boundary.  A place between a
printable ASCII sign and a space or line end is one: the pattern that splits
texts into words never matches across it, whatever stands around, so ids on its
two sides do not depend on each other, and the repaired ids are exactly those of
the whole text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.bits import HashBits
from ledgerline.llm.common import map_batches, texts, written
from ledgerline.llm.records import byte_signs

WINDOW = 5  # the rolling hash sees 2**5 bytes
LEAST, AVERAGE_BITS = 256, 10  # bytes of a chunk: at least, and the power of two that a cut takes on average
#: Begins the names of columns that come and go on the way, apart from those of the documents.
OWN = "_bpe_"
SURE = re.compile(rb"[!-~](?=[ \n])")
_TABLE = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def cuts(data: bytes, least: int = LEAST, average_bits: int = AVERAGE_BITS) -> list[int]:
    """Ends of the chunks of a text; the last is its length.

    The hash of a window is built by doubling: that of 2k bytes from those of
    its halves.  A cut follows a window whose hash has enough zero bits, and the
    cut before it by `least` bytes or more.
    """
    n, width = len(data), 1 << WINDOW
    if n <= max(least, width):
        return [n] if n else []
    rolled = _TABLE[np.frombuffer(data, np.uint8)]
    factor = np.uint32(0x9E3779B1)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            rolled = rolled[: -(1 << k)] * factor + rolled[1 << k :]
            factor = factor * factor
    found = np.flatnonzero(rolled >> np.uint32(32 - average_bits) == 0) + width
    out, last = [], 0
    while (at := int(np.searchsorted(found, last + least))) < len(found) and found[at] < n:
        last = int(found[at])
        out.append(last)
    return [*out, n]


def chunks_of(data: bytes) -> list[bytes]:
    ends = cuts(data)
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def chunk_hash(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def low(digest: bytes) -> int:
    """A part of a digest that fits Spark's long."""
    return int.from_bytes(digest[:8], "big") >> 1


def interior(chunk: bytes) -> tuple[int, int] | None:
    """First and last sure boundary of a chunk, if there is text between them."""
    first = SURE.search(chunk)
    if not first:
        return None
    last, reach = None, 256
    while last is None:
        tail = max(0, len(chunk) - reach)
        for last in SURE.finditer(chunk, tail):
            pass
        reach *= 8
    return (first.end(), last.end()) if last.end() > first.end() else None


class ByteBpe:
    """Ids of a text as the tokenizers library gives them, special tokens in a text included.

    A rank-merging encoder over the same vocabulary does the work, at several
    times the speed; the tests hold it against the tokenizers library.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        byte = byte_signs()
        ranks = {
            bytes(byte[c] for c in token): at for token, at in spec["model"]["vocab"].items() if token not in self.special
        }
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        pieces = {at: piece for piece, at in ranks.items()} | {at: s.encode() for s, at in self.special.items()}
        self.pieces = [pieces.get(at, b"") for at in range(max(pieces, default=-1) + 1)]
        self.kind = np.dtype("<u2" if len(self.pieces) <= 1 << 16 else "<u4")
        self.decimals = [str(at) for at in range(len(self.pieces))]

    def encode(self, text: str) -> list[int]:
        if self.split is None or not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        out: list[int] = []
        for piece in self.split.split(text):
            out += [self.special[piece]] if piece in self.special else self.fast.encode_ordinary(piece)
        return out

    def decode(self, ids: list[int]) -> str:
        """The bytes of the ids; what is no UTF-8 becomes the replacement sign."""
        return b"".join(map(self.pieces.__getitem__, ids)).decode(errors="replace")

    def decimal(self, ids: list[int]) -> str:
        return ",".join(map(self.decimals.__getitem__, ids))


_ENCODERS: dict[str, ByteBpe] = {}


def encoder(path: str) -> ByteBpe:
    """One per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = ByteBpe(path)
    return _ENCODERS[path]


def assembled(coder: ByteBpe, data: bytes, ready: dict[int, np.ndarray]) -> list[int]:
    """Ids of a text from those of the interiors of some of its chunks, by chunk number."""
    out, begun, start = [], 0, 0
    for number, end in enumerate(cuts(data)):
        if number in ready and (inside := interior(data[start:end])):
            out += coder.encode(data[begun : start + inside[0]].decode())
            out += ready[number].tolist()
            begun = start + inside[1]
        start = end
    return out + coder.encode(data[begun:].decode())


def encode_documents(docs: DataFrame, tokenizer: str, keep_ids: bool = True) -> DataFrame:
    """Columns of `docs` but the text, with `n_tokens`, `ids_sha256`, `decoded_sha256` and, if wanted, `ids`.

    A NULL text is an empty one: no ids, and the digest of an empty text.  Rows
    that repeat are all kept; columns of `docs` with one of these names give way.

    The first scan finds which chunk hashes occur in several rows; a bitmap of
    fixed size then tells the second scan which texts surely hold no such chunk,
    and those are done at once.  The others are written; each shared chunk is
    encoded once and its ids are joined back to every text that holds it.  A
    chunk of a third of all rows is one row per task in the shuffle that gathers
    it, and adaptive execution splits the join on it.  A fuller bitmap only sends
    more texts the longer way.
    """
    made = [
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
        *([("ids", pa.list_(pa.int32()))] if keep_ids else []),
    ]
    names = [name for name, _ in made]
    docs = docs.drop(*names)
    others = [c for c in docs.columns if c != "text"]

    def summary(coder: ByteBpe, ids: list[int]) -> tuple:
        decoded = coder.decode(ids).encode()
        digests = (hashlib.sha256(x).hexdigest() for x in (coder.decimal(ids).encode(), decoded))
        return (len(ids), *digests, *([ids] if keep_ids else []))

    def batch_of(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> list[pa.Array]:
        columns = list(zip(*rows)) or [()] * len(fields)
        return [pa.array(c, kind) for c, (_, kind) in zip(columns, fields)]

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [low(h) for text in texts(batch) for h in {chunk_hash(c) for c in chunks_of(text.encode())}]
        yield pa.record_batch([pa.array(found, pa.int64())], ["low"])

    per_hash = map_batches(docs.select("text"), count, pa.schema([("low", pa.int64())])).groupBy("low").count()
    shared = HashBits.of(per_hash.filter("count > 1"), F.col("low"))
    own = list(to_arrow_schema(docs.select(*others).schema))
    later = [(f"{OWN}todo", pa.string()), (f"{OWN}hashes", pa.list_(pa.binary())), (f"{OWN}at", pa.list_(pa.int32()))]

    def home(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        coder, rows = encoder(tokenizer), []
        for text in texts(batch):
            hashes = [chunk_hash(c) for c in chunks_of(text.encode())]
            at = np.flatnonzero(shared.has(np.array([low(h) for h in hashes], np.uint64))).tolist()
            if at:
                rows.append((*(None for _ in made), text, [hashes[k] for k in at], at))
            else:
                rows.append((*summary(coder, coder.encode(text)), None, None, None))
        kept = [batch.column(batch.schema.get_field_index(c)) for c in others]
        arrays = [*kept, *batch_of(rows, [*made, *later])]
        yield pa.record_batch(arrays, names=[*others, *names, *(n for n, _ in later)])

    first = map_batches(docs, home, pa.schema([*own, *made, *later]))
    first = written(first.withColumn(f"{OWN}row", F.monotonically_increasing_id()), "bpe-texts")
    waits = F.col(f"{OWN}todo").isNotNull()
    todo = first.filter(waits)
    plain = todo.select(*[F.col(f"{OWN}{c}").alias(c) for c in ("row", "todo", "at", "hashes")])

    def split(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """One row per marked chunk with its bytes."""
        rows = []
        for text, at, hashes in zip(*(batch.column(k) for k in range(3))):
            chunks = chunks_of(text.as_py().encode())
            rows += [(h, chunks[k]) for k, h in zip(at.as_py(), hashes.as_py())]
        fields = [("hash", pa.binary()), ("chunk", pa.binary())]
        yield pa.record_batch(batch_of(rows, fields), names=[n for n, _ in fields])

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        coder, rows = encoder(tokenizer), []
        for hash_, chunk in zip(*batch.columns):
            data = chunk.as_py()
            if inside := interior(data):
                ids = coder.encode(data[inside[0] : inside[1]].decode())
                rows.append((hash_.as_py(), np.array(ids, coder.kind).tobytes()))
        fields = [("hash", pa.binary()), ("coded", pa.binary())]
        yield pa.record_batch(batch_of(rows, fields), names=[n for n, _ in fields])

    binary = pa.schema([("hash", pa.binary()), ("chunk", pa.binary())])
    once = map_batches(plain.select("todo", "at", "hashes"), split, binary).groupBy("hash").agg(F.first("chunk").alias("chunk"))
    coded = map_batches(once, encode, pa.schema([("hash", pa.binary()), ("coded", pa.binary())]))
    places = plain.select("row", F.explode(F.arrays_zip("at", "hashes")).alias("p")).select("row", "p.at", F.col("p.hashes").alias("hash"))
    ready = places.join(coded, "hash").groupBy("row").agg(F.collect_list(F.struct("at", "coded")).alias(f"{OWN}ready"))

    def join(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        coder, rows = encoder(tokenizer), []
        for text, found in zip(batch.column(0), batch.column(1)):
            known = {p["at"]: np.frombuffer(p["coded"], coder.kind) for p in found.as_py() or ()}
            rows.append(summary(coder, assembled(coder, text.as_py().encode(), known)))
        yield pa.record_batch([*batch.columns[2:], *batch_of(rows, made)], names=[*others, *names])

    matched = todo.join(ready.withColumnRenamed("row", f"{OWN}row"), f"{OWN}row", "left")
    late = map_batches(matched.select(f"{OWN}todo", f"{OWN}ready", *others), join, pa.schema([*own, *made]))
    return first.filter(~waits).select(*others, *names).unionByName(late)
