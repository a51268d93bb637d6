"""Benchmark decontamination: shared word pairs find passages, Smith-Waterman alignment scores them.

An item and a document that share so many word pairs that the alignment could
reach the least score are aligned around them, word by word, so copies with words
changed, dropped or put in still score high, while texts that share a common
phrase do not.  No passage that reaches the least score is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bits import HashBits
from ledgerline.llm.common import map_batches, texts, written
from ledgerline.llm.shingles import gram_hashes, word_hashes, words_of

MATCH, MISMATCH, GAP = 2, -1, -1


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two sequences of word hashes: score, and first and last passage word (exclusive).

    Row by row over the item; a gap in the passage is a running maximum along the row.
    """
    width = len(passage)
    slope = np.arange(width + 1) * -GAP
    above = np.zeros(width + 1, np.int64)
    begun = np.arange(width + 1)
    best = (0, 0, 0)
    for word in item:
        step = np.where(passage == word, MATCH, MISMATCH)
        here, start = np.zeros(width + 1, np.int64), np.arange(width + 1)
        diagonal, up = above[:-1] + step, above[1:] + GAP
        take = diagonal >= up
        value = np.where(take, diagonal, up)
        origin = np.where(take, begun[:-1], begun[1:])
        good = value > 0
        here[1:][good], start[1:][good] = value[good], origin[good]
        # A gap that crosses k passage words costs k times GAP.
        raised = here + slope
        running = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == running, np.arange(width + 1), 0))
        here, start = running - slope, start[source]
        at = int(here.argmax())
        if here[at] > best[0]:
            best = (int(here[at]), int(start[at]), at)
        above, begun = here, start
    return best


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of each pair of words."""
    with np.errstate(over="ignore"):
        out = (first * np.uint64(0x9E3779B97F4A7C15) ^ second) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def near_pairs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words that are neighbours or have one word between them, and the place of each one's first word."""
    close, apart = pair_hashes(hashes[:-1], hashes[1:]), pair_hashes(hashes[:-2], hashes[2:])
    return np.concatenate([close, apart]), np.concatenate([np.arange(len(close)), np.arange(len(apart))])


def least_pairs(length: int, least: float) -> int:
    """How many of its pairs of neighbours an item must find as near pairs of a passage that scores `least`.

    Of the steps from one match to the next, let P be such pairs and k those that
    skip words of the item.  Any other step costs as much as its match brings, a
    skip costs half of it, so the score is at most 2 + 2 P + k.  The steps fit in
    the item, so 1 + P + 2 k <= length.  Together: 1.5 P >= score - 1.5 - length / 2.
    """
    return math.ceil((MATCH * least * length - 1.5 - length / 2) / 1.5 - 1e-9)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 4,
    least: float = 0.5,
    bits: int = 24,
) -> DataFrame:
    """One row per (doc_id, item_id) whose best alignment scores at least `least` of the item's own score.

    Columns: doc_id, item_id, score (1 for a whole copy), start_word and end_word
    of the passage in the document.

    A passage that scores `least` holds at least `least_pairs` of the item's pairs
    of neighbours, with at most one word put in between.  So it holds one of any
    set of the item's pairs that leaves out fewer than that: its most common ones
    are left out, the others are seeds.  How common pairs are is counted over all
    documents; this decides what is compared, not what is found.  `least`
    must exceed 0.25 + 0.75 / n, below which a passage may have no such pair.

    Items of fewer than n words are found as whole documents only.  NULL or empty
    texts and items match nothing; rows without an id are left out; repeated rows
    of a document or an item give one row of the result, the best.

    Documents are scanned twice, to count and to find.  Bitmaps of fixed size
    drop the pairs that are no seeds; what is left keeps the words around it, as
    hashes, and is joined to the items exactly.  Joins are on pairs and item rows:
    adaptive execution splits one that a third of all documents holds.
    """
    if least_pairs(n, least) < 1:
        raise ValueError("least must exceed 0.25 + 0.75 / n")
    item_schema = pa.schema(
        [("item_id", pa.int64()), ("item", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64())), ("need", pa.int32())]
    )

    def read_items(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for item_id, text in zip(batch.column(0).to_pylist(), texts(batch)):
            hashes = word_hashes(words_of(text))
            if len(hashes):
                short = len(hashes) < n
                own = gram_hashes(hashes, n) if short else pair_hashes(hashes[:-1], hashes[1:])
                need = 1 if short else least_pairs(len(hashes), least)
                rows.append((item_id, hashes.view(np.int64), own.view(np.int64), need))
        columns = list(zip(*rows)) or [()] * len(item_schema)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, item_schema)], schema=item_schema)

    def grams_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What a document may share with items, and where: near pairs, and all words of a short one."""
        own, at = near_pairs(hashes)
        if 0 < len(hashes) < n:
            own, at = np.append(own, gram_hashes(hashes, n)), np.append(at, 0)
        return own, at

    read = map_batches(benchmark.select("item_id", "text").filter("item_id IS NOT NULL"), read_items, item_schema)
    items = written(read.withColumn("item_row", F.monotonically_increasing_id()), "items")
    longest = items.agg(F.max(F.size("item"))).first()[0] or 1
    # So many words a passage that scores `least` may span, for each word put in costs.
    reach = math.ceil((3 - MATCH * least) * longest) + n
    grams = items.select("item_row", "need", F.explode("grams").alias("gram"))
    all_grams = HashBits.of(grams, F.col("gram"), bits)
    known = docs.select("doc_id", "text").filter("doc_id IS NOT NULL")
    df_schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        parts = [np.empty(0, np.uint64)]
        for text in texts(batch):
            own, _ = grams_of(word_hashes(words_of(text)))
            parts.append(np.unique(own[all_grams.has(own)]))
        gram, times = np.unique(np.concatenate(parts), return_counts=True)
        yield pa.record_batch([pa.array(gram.view(np.int64)), pa.array(times)], schema=df_schema)

    common = map_batches(known, count, df_schema).groupBy("gram").agg(F.sum("n").alias("df"))
    of_item = grams.join(common, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    # An item's grams are few: as many as its words.
    ranked = of_item.groupBy("item_row", "need").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("all"))
    chosen = ranked.select("item_row", F.explode(F.slice("all", F.lit(1), F.size("all") - F.col("need") + 1)).alias("g"))
    seed_rows = written(chosen.select("item_row", F.col("g.gram").alias("gram")).distinct(), "seeds")
    marked = [HashBits.of(seed_rows, F.shiftrightunsigned("gram", k), bits) for k in (0, 32)]

    window_schema = pa.schema(
        [("doc_id", pa.int64()), ("first_word", pa.int64()), ("passage", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))]
    )

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Stretches of words around marked grams; grams that stand close share one stretch."""
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch)):
            hashes = word_hashes(words_of(text))
            own, at = grams_of(hashes)
            hits = np.flatnonzero(marked[0].has(own))
            hits = hits[marked[1].has(own[hits] >> np.uint64(32))]
            if not len(hits):
                continue
            hits = hits[np.argsort(at[hits], kind="stable")]
            for part in np.split(hits, np.flatnonzero(np.diff(at[hits]) > reach) + 1):
                a, b = max(0, at[part[0]] - reach), min(len(hashes), at[part[-1]] + n + reach)
                rows.append((doc_id, a, hashes[a:b].view(np.int64), np.unique(own[part]).view(np.int64)))
        columns = list(zip(*rows)) or [()] * 4
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, window_schema)], schema=window_schema)

    windows = written(map_batches(known, find, window_schema).withColumn("at", F.monotonically_increasing_id()), "passages")
    held = windows.select("at", F.explode("grams").alias("gram"))
    pairs = held.join(seed_rows, "gram").select("at", "item_row").distinct()
    joined = pairs.join(windows.select("at", "doc_id", "first_word", "passage"), "at").join(
        items.select("item_row", "item_id", "item", "need"), "item_row"
    )

    out = pa.schema(
        [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64())]
    )

    def judge(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for doc_id, item_id, first, passage, item, need in zip(*batch.columns):
            words, around = item.values.to_numpy(), passage.values.to_numpy()
            if len(words) >= n:
                found, _ = near_pairs(around.view(np.uint64))
                own = pair_hashes(words[:-1].view(np.uint64), words[1:].view(np.uint64))
                if np.isin(own, found).sum() < need.as_py():
                    continue
            value, a, b = align(words, around)
            share = value / (MATCH * len(words))
            if share >= least:
                rows.append((doc_id.as_py(), item_id.as_py(), share, first.as_py() + a, first.as_py() + b))
        columns = list(zip(*rows)) or [()] * len(out)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    scored = map_batches(joined.select("doc_id", "item_id", "first_word", "passage", "item", "need"), judge, out)
    best = F.max_by(F.struct("score", "start_word", "end_word"), F.struct("score", -F.col("start_word")))
    return scored.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.*")
