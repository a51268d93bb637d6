"""Hard negatives by a secondary sort: an anchor's rows stream by in the order of their scores.

Scores are inner products of integer vectors.  Anchors go out in blocks of bounded size; every task
scores its own rows against a block and hands on what may count.  A first scan finds each anchor's
positives, a second one the rows of other labels that lie first in a positive's window; per task and
window a fixed number of rows at most.  Both are packed into keys (anchor, descending score, kind, id).
`repartition` by anchor and `sortWithinPartitions` by key, the DataFrame form of
repartitionAndSortWithinPartitions, bring them in order, and one pass over each partition opens the
window of a positive when it comes by and emits negatives while the window is open.  It holds the
open windows of one anchor and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ledgerline.llm.common import written

#: Anchors that one scan sends to every task, cells of scores held at once, and rows scored at once.
ANCHOR_BLOCK, CELLS, ROWS = 4_096, 1 << 21, 1 << 12

_KEYED = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("key", pa.binary())])
_FOUND = pa.schema(
    [
        ("anchor_id", pa.int64()),
        ("positive_id", pa.int64()),
        ("rank", pa.int32()),
        ("negative_id", pa.int64()),
        ("positive_score", pa.int64()),
        ("negative_score", pa.int64()),
    ]
)
_LONG = 1 << 63
_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
POSITIVE, NEGATIVE = 0, 1


def packed_keys(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.Array:
    """Keys whose bytes sort by anchor, then by descending score, positives first, then by id."""
    out = np.empty(len(anchor), _KEY)
    flip = np.uint64(_LONG)
    out["anchor"] = anchor.astype(np.int64).view(np.uint64) ^ flip
    out["score"] = ~(score.astype(np.int64).view(np.uint64) ^ flip)
    out["kind"] = kind
    out["id"] = ids.astype(np.int64).view(np.uint64) ^ flip
    fixed = pa.Array.from_buffers(pa.binary(_KEY.itemsize), len(out), [None, pa.py_buffer(out.tobytes())])
    return fixed.cast(pa.binary())


def unpacked_keys(keys: pa.Array) -> np.ndarray:
    """Rows (anchor, score, kind, id) of packed keys, as longs."""
    raw = np.frombuffer(b"".join(keys.to_pylist()), _KEY)
    flip, out = np.uint64(_LONG), np.empty((len(raw), 4), np.int64)
    out[:, 0] = (raw["anchor"].astype(np.uint64) ^ flip).view(np.int64)
    out[:, 1] = (~raw["score"].astype(np.uint64) ^ flip).view(np.int64)
    out[:, 2] = raw["kind"]
    out[:, 3] = (raw["id"].astype(np.uint64) ^ flip).view(np.int64)
    return out


def quantized(vectors: pa.Array, scale: int) -> np.ndarray:
    """floor(scale * x) as a matrix of whole doubles; a shorter vector ends in zeros."""
    lengths = np.asarray(vectors.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    out = np.zeros((len(vectors), int(lengths.max(initial=0))))
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    rows = np.repeat(np.arange(len(vectors)), lengths)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices; beyond a long they stop at its ends."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(width, 1) < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(a).dot(whole(b).T), -_LONG, _LONG - 1).astype(np.int64)


def _largest(scores: np.ndarray) -> int:
    return max(-int(scores.min(initial=0)), int(scores.max(initial=0)))


def _first(scores: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the n highest allowed scores of each row, of equal ones those further left."""
    columns = scores.shape[1]
    if not allowed.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if _largest(scores) >= _LONG // (2 * columns):
        # Too large to hold a column number beside the score: ranks serve as well.
        scores = np.unique(scores, return_inverse=True)[1].reshape(scores.shape)
    order = np.where(allowed, -scores.astype(np.int64) * columns + np.arange(columns), _LONG - 1)
    if columns > n:
        at = np.argpartition(order, n - 1, axis=1)[:, :n]
    else:
        at = np.broadcast_to(np.arange(columns), scores.shape)
    rows = np.repeat(np.arange(len(scores)), at.shape[1])
    at = at.ravel()
    good = allowed[rows, at]
    return rows[good], at[good]


class _Best:
    """The n best (score, id) of each of some lists, best first: higher scores, then smaller ids."""

    def __init__(self, n: int):
        self.n = n
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(at):
            self.parts.append((at, score, ids))
            self.held += len(at)
            if self.held > 1 << 20 and len(self.parts) > 1:
                self.parts = [self.best()]
                self.held = len(self.parts[0][0])

    def best(self) -> tuple[np.ndarray, ...]:
        if not self.parts:
            return (np.empty(0, np.int64),) * 3
        at, score, ids = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ids, ~score, at))
        at, score, ids = at[order], score[order], ids[order]
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        keep = place < self.n
        return at[keep], score[keep], ids[keep]


def _score(
    batches: Iterator[pa.RecordBatch], sent, scale: int, n: int, bounds: tuple[int, int] | None
) -> Iterator[pa.RecordBatch]:
    """Of this task's rows, for each anchor of the block, the first n of its label, or in each of its windows.

    `sent` has the anchors as matrix, rows, ids and labels, and the scores of their positives (anchor,
    k), the least long where there is none.
    """
    block, rows_of, ids_of, labels, windows = sent.value
    kind = POSITIVE if bounds is None else NEGATIVE
    lists = 1 if bounds is None else windows.shape[1]
    best, step = _Best(n), max(CELLS // ROWS, 1)
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            batch = whole.slice(start, ROWS)
            ids = batch.column("vec_id").to_numpy()
            # In the order of their ids, so that of equal scores the first counts.
            order = np.argsort(ids, kind="stable")
            ids, label, row = ids[order], batch.column("label").to_numpy()[order], batch.column("row").to_numpy()[order]
            vectors = quantized(batch.column("vector"), scale)[order]
            for low in range(0, len(block), step):
                anchors = slice(low, low + step)
                scores = inner_products(block[anchors], vectors)
                same = labels[anchors, None] == label[None, :]
                if bounds is None:
                    at, column = _first(scores, same & (rows_of[anchors, None] != row[None, :]), n)
                    best.add(low + at, scores[at, column], ids[column])
                    continue
                for k in range(lists):
                    p = windows[anchors, k, None]
                    at, column = _first(scores, ~same & _inside(scores, p, bounds), n)
                    best.add((low + at) * lists + k, scores[at, column], ids[column])
    at, score, ids = best.best()
    anchor = at // lists
    # A row may lie in several windows of an anchor; it is handed on once.
    if lists > 1 and len(at):
        keep = np.unique(np.stack([anchor, score, ids]), axis=1, return_index=True)[1]
        anchor, score, ids = anchor[keep], score[keep], ids[keep]
    for start in range(0, len(anchor), 1 << 16):
        part = slice(start, start + (1 << 16))
        keys = packed_keys(rows_of[anchor[part]], score[part], kind, ids[part])
        yield pa.record_batch([pa.array(rows_of[anchor[part]]), pa.array(ids_of[anchor[part]]), keys], schema=_KEYED)


def _inside(scores: np.ndarray, positive: np.ndarray, bounds: tuple[int, int]) -> np.ndarray:
    """low * positive <= 100 * score <= high * positive, without leaving the longs."""
    low, high = bounds
    if max(_largest(scores), _largest(positive)) < _LONG // 256:
        return (100 * scores >= low * positive) & (100 * scores <= high * positive)
    exact, at = scores.astype(object) * 100, positive.astype(object)
    return ((exact >= low * at) & (exact <= high * at)).astype(bool)


def _streamed(batches: Iterator[pa.RecordBatch], positives: int, negatives: int, bounds: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Sorted keys to (anchor, positive, negative) rows; what is held are the windows of the anchor that goes by."""
    low, high = bounds
    now, opened, windows = None, 0, []
    for batch in batches:
        out: list[tuple] = []
        anchor_ids = batch.column("anchor_id").to_pylist()
        for anchor_id, (anchor, score, kind, other) in zip(anchor_ids, unpacked_keys(batch.column("key")).tolist()):
            if anchor != now:
                now, opened, windows = anchor, 0, []
            if kind == POSITIVE:
                if opened < positives:
                    opened += 1
                    windows.append([other, score, 0])
                continue
            for window in windows:
                positive_id, positive, given = window
                if given < negatives and low * positive <= 100 * score <= high * positive:
                    window[2] += 1
                    out.append((anchor_id, positive_id, given + 1, other, positive, score))
            # Scores only fall from here on, so a window that is full or lies above is done with.
            windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    bounds: tuple[int, int] = (30, 90),
    scale: int = 256,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that `anchors` marks.

    Reads vec_id, label and embedding.  Rows with a NULL id, label or vector, or a NULL or not finite
    component take no part.  Components are floor(scale * x); a score is the inner product with the
    anchor, a shorter vector ends in zeros, and a sum beyond a long stops at its end.  Higher scores
    come first, of equal ones smaller ids.  An anchor's positives are its first other rows of its
    label; a positive's negatives are the first rows of other labels with low * positive <= 100 *
    score <= high * positive, both bounds at most 100.  Rows that repeat an id are rows of their own, and so are anchors.
    Without rows, anchors or negatives there is no row; other columns may have any names.
    """
    spark = vectors.sparkSession
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.col("label").cast("bigint").alias("label"),
            F.col("embedding").cast("array<double>").alias("vector"),
            F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
        ),
        "vectors",
    )
    chosen = rows.filter("is_anchor").drop("is_anchor")
    blocks = -(-chosen.count() // anchor_block)
    scored, keyed = rows.drop("is_anchor"), from_arrow_schema(_KEYED)
    parts = []
    for at in range(blocks):
        block = chosen.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == at).toArrow().combine_chunks()
        if not block.num_rows:
            continue
        matrix = quantized(block.column("vector").combine_chunks(), scale)
        rows_of, ids_of, labels = (block.column(c).to_numpy() for c in ("row", "vec_id", "label"))
        sent = spark.sparkContext.broadcast((matrix, rows_of, ids_of, labels, None))
        near = scored.mapInArrow(partial(_score, sent=sent, scale=scale, n=positives, bounds=None), keyed)
        place = F.row_number().over(Window.partitionBy("anchor").orderBy("key"))
        first = written(near.withColumn("place", place).filter(F.col("place") <= positives).drop("place"), f"positives-{at}")
        found = first.select("key").toArrow()  # `positives` rows for each anchor of the block
        index = {row: i for i, row in enumerate(rows_of.tolist())}
        windows = np.zeros((len(rows_of), positives), np.int64)
        filled = np.zeros(len(rows_of), np.int64)
        for anchor, score, _, _ in unpacked_keys(found.column("key").combine_chunks()).tolist():
            windows[index[anchor], filled[index[anchor]]] = score
            filled[index[anchor]] += 1
        # A list without a positive repeats another one of its anchor, or asks for what nothing passes.
        for k in range(positives):
            none = filled <= k
            windows[none, k] = np.where(filled[none] > 0, windows[none, 0], -1)
        sent.unpersist()
        sent = spark.sparkContext.broadcast((matrix, rows_of, ids_of, labels, windows))
        hard = scored.mapInArrow(partial(_score, sent=sent, scale=scale, n=negatives, bounds=bounds), keyed)
        parts += [first, written(hard, f"negatives-{at}")]
        sent.unpersist()
    if not parts:
        return spark.createDataFrame([], from_arrow_schema(_FOUND))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    in_order = reduce(DataFrame.unionByName, parts).repartition(tasks, "anchor").sortWithinPartitions("key")
    stream = partial(_streamed, positives=positives, negatives=negatives, bounds=bounds)
    return in_order.mapInArrow(stream, from_arrow_schema(_FOUND))
