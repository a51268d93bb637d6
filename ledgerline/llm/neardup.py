"""Near-duplicate documents: b-bit MinHash, band candidates, links confirmed on full shingle sets.

Documents with one shingle set form a class, and only classes are compared.
Classes that agree in a band of minima share a bucket.  Within a bucket not all
pairs are formed: a pivot is compared with all other members, and a bucket is
done once its members without the former pivots are all in one component,
for then no pair that is left can join two components.  A pair is looked at only
while its two classes are in different components.  First by its packed
signatures: the low bits of the minima, compared by counting bits and corrected
for the chance that low bits agree by accident.  What may be similar is
confirmed on the full sets.

Shingles that only one class has bound what it can share with any other, and so
the sizes that a partner of it may have, exactly: variants that lie too far from
all others are not compared.  After a few rounds of pivots the pairs that these
bounds leave are looked up by the rarest shingles of each class, the place of a
shingle bounding the size of a partner, which ends the search.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.bits import HashBits
from ledgerline.llm.common import discard, if_small, map_batches, texts, written
from ledgerline.llm.graph import components
from ledgerline.llm.shingles import gram_hashes, word_hashes, words_of

MINIMA, BAND, LOW_BITS = 128, 4, 4

_DRAW = np.random.default_rng(3)
_FACTOR = (_DRAW.integers(0, 1 << 32, MINIMA, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
_SHIFT = _DRAW.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)[:, None]


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes; the whole sequence where there are fewer words, none without words."""
    return np.unique(gram_hashes(word_hashes(words_of(text)), words))


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each of `MINIMA` permutations of 32 bits."""
    values = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), 2048):
        np.minimum(out, (values[at : at + 2048] * _FACTOR + _SHIFT).min(axis=1), out=out)
    return out


def packed(smallest: np.ndarray) -> np.ndarray:
    """Low bits of the minima, sixteen to a 64-bit word."""
    low = (smallest & np.uint32((1 << LOW_BITS) - 1)).astype(np.uint64).reshape(-1, 64 // LOW_BITS)
    return np.bitwise_or.reduce(low << np.arange(0, 64, LOW_BITS, dtype=np.uint64), axis=1)


def bands(smallest: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each band of minima; bands have hashes of their own."""
    rows = smallest.reshape(-1, BAND).astype(np.uint64)
    out = np.arange(1, len(rows) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for k in range(BAND):
            out = (out ^ rows[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
            out ^= out >> np.uint64(31)
    return out


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures, corrected for accidental agreement of low bits."""
    each = F.lit(sum(1 << k for k in range(0, 64, LOW_BITS)))

    def differ(x: Column) -> Column:
        folded = x
        for k in range(1, LOW_BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, k))
        return F.bit_count(folded.bitwiseAND(each)).cast("double")

    words = [differ(a[k].bitwiseXOR(b[k])) for k in range(MINIMA * LOW_BITS // 64)]
    agree = 1 - sum(words[1:], words[0]) / MINIMA
    chance = 2.0**-LOW_BITS
    return (agree - chance) / (1 - chance)


SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("node", pa.binary()),
        ("n_shingles", pa.int64()),
        ("sig", pa.list_(pa.int64())),
        ("bands", pa.list_(pa.int64())),
        ("row", pa.int64()),
    ]
)


def signatures(docs: DataFrame, words: int, row: str | None = None) -> DataFrame:
    """Per row: the key of its shingle set, the set's size, packed signature and band hashes; NULLs for no words."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = []
        for doc_id, number, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts(batch)):
            shingles = shingle_set(text, words)
            if len(shingles):
                smallest = minima(shingles)
                sig, band = packed(smallest).view(np.int64), bands(smallest).view(np.int64)
                rows.append((doc_id, set_key(shingles), len(shingles), sig, band, number))
            else:
                rows.append((doc_id, None, 0, None, None, number))
        columns = list(zip(*rows)) or [()] * len(SIGNED)
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, SIGNED)], schema=SIGNED)

    number = F.lit(None).cast("bigint") if row is None else F.col(row)
    return map_batches(docs.select("doc_id", "text", number.alias("row")), work, SIGNED)


def _confirmed(pairs: DataFrame, held: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    percent = round(similarity * 100)
    out = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        good, known = [], {}
        for a, b, x, y in zip(*batch.columns):
            if len(known) > 64:
                known.clear()
            sets = []
            for key, text in ((a.as_py(), x), (b.as_py(), y)):
                if key not in known:
                    known[key] = shingle_set(text.as_py(), words)
                sets.append(known[key])
            same = len(np.intersect1d(*sets, assume_unique=True))
            if 100 * same >= percent * (len(sets[0]) + len(sets[1]) - same):
                good.append((a.as_py(), b.as_py()))
        columns = list(zip(*good)) or [(), ()]
        yield pa.record_batch([pa.array(c, pa.binary()) for c in columns], schema=out)

    one, other = (held.select(F.col("node").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
    joined = one.join(if_small(pairs.select("a", "b")), "a").join(other, "b")
    return map_batches(joined.select("a", "b", "text_a", "text_b"), work, out)


def _texts_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """One text for each class (node, rep): documents are filtered by a bitmap of fixed size, then joined exactly."""
    marked = HashBits.of(nodes, F.xxhash64("rep"))
    out = pa.schema([("node", pa.binary()), ("text", pa.string())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        places = np.flatnonzero(marked.has(batch.column(2).to_numpy().view(np.uint64)))
        found = [t or "" for t in batch.column(1).take(pa.array(places)).to_pylist()]
        yield pa.record_batch([pa.array([set_key(shingle_set(t, words)) for t in found], pa.binary()), pa.array(found, pa.string())], schema=out)

    known = docs.filter("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id").alias("hash"))
    # Documents that repeat an id may come along; the join on the class drops them, the minimum keeps one text.
    return map_batches(known, work, out).join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))


#: Rounds of pivots before the pairs that are left are looked up, and standard deviations that an estimate may lie too low.
PIVOT_ROUNDS, DEVIATIONS = 2, 6


def near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8, row: str | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Two documents are linked if their sets of distinct shingles of `words` words
    have a Jaccard similarity of `similarity` or more, a whole percentage;
    `component_id` is the smallest doc_id that links lead to.  Words stand
    between ASCII white space, in lower case (A-Z).  A text with fewer words is
    one shingle; one without words, or NULL, has none and is linked with nothing,
    and so is a row without an id (component NULL, kept).  Rows that repeat an id
    belong to the component of their text; those that also repeat the text all
    have the same result.  Other columns are not looked at.  With `row`, a column
    that numbers the rows with longs, the result has it too, and `component`, which
    is equal just for the rows of one component, NULL for rows linked with nothing.

    A pair at the threshold is missed by all bands with probability
    (1 - 0.8**4)**32 < 1e-7; the estimate drops a pair only when it lies six
    standard deviations below, which at the threshold has a probability below 1e-7.
    """
    signed = written(signatures(docs, words, row), "signatures")
    usable = signed.filter("node IS NOT NULL AND doc_id IS NOT NULL")
    classes = written(
        usable.groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands")
        ),
        "classes",
    )
    labels = _labels(docs, classes, words, similarity)
    known = classes.select("node", "rep").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = known.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_class = known.join(lowest, "label").select("node", "component_id", F.col("label").alias("component"))
    # A class of a third of all rows meets one row of the other side; adaptive execution splits its rows.
    found = usable.select("doc_id", "node", "n_shingles", "row").join(of_class, "node").drop("node")
    rest = signed.filter("node IS NULL OR doc_id IS NULL").select(
        "doc_id",
        "n_shingles",
        "row",
        F.when(F.col("node").isNull(), F.col("doc_id")).alias("component_id"),
        F.lit(None).cast("binary").alias("component"),
    )
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")) | F.col("doc_id").isNull()
    more = [] if row is None else [F.col("row").alias(row), "component"]
    return found.unionByName(rest).select("doc_id", "n_shingles", "component_id", kept.alias("kept"), *more)


def _labels(docs: DataFrame, classes: DataFrame, words: int, similarity: float) -> DataFrame:
    """(node, label) for the classes that share a bucket with another one."""
    spread = classes.select("node", F.explode("bands").alias("key"))
    sizes = spread.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = written(spread.join(sizes, "key"), "buckets")
    # A class in many large buckets is near the middle of its group: as a pivot it links most.
    weight = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    active = written(classes.drop("bands").join(weight, "node"), "bucket-classes")
    held = written(_texts_of(docs, active.select("node", "rep"), words), "bucket-texts")
    labels = active.select("node", F.col("node").alias("label"))
    percent = round(similarity * 100)
    own = _own_shingles(active, held, words)
    # The largest partner that a class may have: two sets share no more than what either has in common with any other.
    reach = F.floor(((100 + percent) * (F.col("n") - F.col("own")) - percent * F.col("n")) / percent)
    known = active.join(if_small(own), "node").withColumn("reach", reach)
    members = shared.select("key", "node").join(
        known.select("node", F.col("node").alias("label"), "n", "reach", "sig", "weight"), "node"
    )
    # A partner has that share of a class's size at least.
    members = written(members.filter(100 * F.col("reach") >= percent * F.col("n")), "members")

    agreement = 2.0**-LOW_BITS + (1 - 2.0**-LOW_BITS) * similarity
    least = similarity - DEVIATIONS * math.sqrt(agreement * (1 - agreement) / MINIMA) / (1 - 2.0**-LOW_BITS)
    tried: list[DataFrame] = []
    for turn in range(PIVOT_ROUNDS + 1):
        mixed = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        left = written(members.join(mixed.filter("low <> high").select("key"), "key", "left_semi"), "members")
        discard(members)
        members = left
        if members.isEmpty():
            break
        pivots = None
        if turn < PIVOT_ROUNDS:
            pivots, pairs = _pivot_pairs(members, 2**turn, least)
        else:
            pairs = _pairs_left(_by_rare_shingle(members, held, words, percent), percent, least)
        # A pair that came up before was confirmed, refused or settled by others.
        if tried:
            pairs = pairs.join(if_small(reduce(DataFrame.unionByName, tried)), ["a", "b"], "left_anti")
        pairs = written(pairs.groupBy("a", "b").agg(F.first("member").alias("member"), F.first("est").alias("est")), "pairs")
        tried.append(pairs.select("a", "b"))
        # One likely link for each class settles most components; few pairs are left to confirm.
        best = pairs.groupBy("member").agg(F.max(F.struct("est", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
        best = written(best, "best")
        labels = _linked(labels, best, held, words, similarity)
        pairs = written(_apart(pairs.join(if_small(best), ["a", "b"], "left_anti").select("a", "b"), labels), "pairs")
        labels = _linked(labels, pairs, held, words, similarity)
        if pivots is None:
            break
        spent = pivots.select("key", F.col("p.node").alias("node"))
        left = members.join(if_small(spent), ["key", "node"], "left_anti").drop("label").join(if_small(labels), "node")
        left = written(left, "members")
        discard(members, pivots)
        members = left
    return labels


def _candidates(joined: DataFrame, least: float) -> DataFrame:
    """(a, b, member, est) of joined rows (node, sig, other_node, other_sig) that the estimate leaves."""
    est = estimate(F.col("sig"), F.col("other_sig"))
    return joined.withColumn("est", est).filter(F.col("est") >= least).select(
        F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b"), F.col("node").alias("member"), "est"
    )


def _pivot_pairs(members: DataFrame, groups: int, least: float) -> tuple[DataFrame, DataFrame]:
    """Pivots of the buckets, one for each of some groups of labels, and the pairs of members with them."""
    whole = F.struct("weight", "node", "label", "n", "reach", "sig")
    group = F.pmod(F.xxhash64("label"), F.lit(groups))
    pivots = written(members.groupBy("key", group.alias("g")).agg(F.max(whole).alias("p")), "pivots")
    near = (F.col("n") <= F.col("p.reach")) & (F.col("p.n") <= F.col("reach"))
    against = members.join(if_small(pivots.select("key", "p")), "key").filter((F.col("label") != F.col("p.label")) & near)
    return pivots, _candidates(against.select("node", "sig", F.col("p.node").alias("other_node"), F.col("p.sig").alias("other_sig")), least)


def _by_rare_shingle(members: DataFrame, held: DataFrame, words: int, percent: int) -> DataFrame:
    """The members, once for each of the shingles at which they may meet a partner, with a reach at each.

    Shingles are ordered by the number of classes that have them, rare ones first.  The first one that two sets
    have in common, at place k in one of n, leaves them n - k + 1 to share at most; so of each class only the
    places are kept that leave a partner possible, and each bounds its size.  In a group of variants those too
    far from the middle meet nobody at a shingle of the whole group.
    """
    nodes = written(members.select("node", "label", "n", "sig").distinct(), "leftover")
    sets = written(_shingles(held.join(if_small(nodes.select("node")), "node", "left_semi"), words), "leftover-shingles")
    spread = sets.select("node", F.explode("shingles").alias("key"))
    df = written(spread.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "leftover-df")
    of_node = Window.partitionBy("node")
    # Shingles that no other one has come first, and need not be listed.
    ordered = spread.join(if_small(df), "key").select(
        "node", "key", F.row_number().over(of_node.orderBy("df", "key")).alias("at"), F.count(F.lit(1)).over(of_node).alias("shared")
    )
    known = ordered.join(if_small(nodes), "node")
    reach = F.floor(((100 + percent) * (F.col("shared") - F.col("at") + 1) - percent * F.col("n")) / percent)
    placed = known.withColumn("reach", reach).filter(100 * F.col("reach") >= percent * F.col("n"))
    placed = written(placed.select("key", "node", "label", "n", "reach", "sig"), "placed")
    discard(sets)
    mixed = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return placed.join(if_small(written(mixed.filter("low <> high").select("key"), "mixed")), "key", "left_semi")


def _pairs_left(members: DataFrame, percent: int, least: float) -> DataFrame:
    """All pairs of one key with different labels whose sizes lie within each other's reach.

    A class asks only for the sizes, of those at its key, at which some class of another label
    may be its partner; then key and size are what the join is on.
    """
    by_label = members.groupBy("key", "n", "label").agg(F.max("reach").alias("reach"))
    top = by_label.groupBy("key", "n").agg(F.max(F.struct("reach", "label")).alias("top"))
    other = by_label.join(top, ["key", "n"]).filter(F.col("label") != F.col("top.label"))
    second = other.groupBy("key", "n").agg(F.max("reach").alias("second"))
    sizes = written(top.join(second, ["key", "n"], "left").select("key", F.col("n").alias("size"), "top", "second"), "sizes")
    farthest = F.when(F.col("label") == F.col("top.label"), F.col("second")).otherwise(F.col("top.reach"))
    fits = (F.col("size") <= F.col("n")) & (100 * F.col("size") >= percent * F.col("n")) & (F.col("size") <= F.col("reach"))
    asked = members.join(if_small(sizes), "key").filter(fits & (farthest >= F.col("n"))).select("key", "size", "node", "label", "n", "sig")
    others = members.select(
        "key", F.col("n").alias("size"), F.col("node").alias("other_node"), F.col("label").alias("other_label"),
        F.col("reach").alias("other_reach"), F.col("sig").alias("other_sig"),
    )
    # Of two classes of one size the one with the larger key asks.
    once = (F.col("size") < F.col("n")) | (F.col("other_node") < F.col("node"))
    asked = if_small(written(asked, "asked"))
    found = others.join(asked, ["key", "size"]).filter((F.col("label") != F.col("other_label")) & (F.col("other_reach") >= F.col("n")) & once)
    return _candidates(found, least)


def _shingles(held: DataFrame, words: int) -> DataFrame:
    """(node, shingles): the set of each class."""
    out = pa.schema([("node", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = [shingle_set(t, words).view(np.int64) for t in texts(batch)]
        yield pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], schema=out)

    return map_batches(held.select("node", "text"), work, out)


def _own_shingles(nodes: DataFrame, held: DataFrame, words: int) -> DataFrame:
    """(node, own): how many shingles of a class no other one of these classes has."""
    single = (
        _shingles(held, words).select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("df"), F.min("node").alias("node"))
        .filter("df = 1")
    )
    # A row per class with shingles of its own, and one for the class itself.
    single = single.groupBy("node").agg(F.count(F.lit(1)).alias("k"))
    counts = nodes.select("node", F.lit(0).cast("bigint").alias("k")).unionByName(single)
    return written(counts.groupBy("node").agg(F.sum("k").alias("own")), "own-shingles")


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends have different labels."""
    known = if_small(labels)
    one, other = (known.select(F.col("node").alias(k), F.col("label").alias(f"label_{k}")) for k in "ab")
    return pairs.join(one, "a").join(other, "b").filter("label_a <> label_b").select("a", "b")


def _linked(labels: DataFrame, pairs: DataFrame, held: DataFrame, words: int, similarity: float) -> DataFrame:
    """Labels after the links among the pairs have been confirmed."""
    links = written(_confirmed(pairs, held, words, similarity), "links")
    if links.isEmpty():
        return labels
    known = if_small(labels)
    one, other = (known.select(F.col("node").alias(k), F.col("label").alias(f"label_{k}")) for k in "ab")
    between = links.join(one, "a").join(other, "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    merged = written(components(between).select(F.col("node").alias("label"), F.col("label").alias("lower")), "merged")
    return written(labels.join(if_small(merged), "label", "left").select("node", F.coalesce("lower", "label").alias("label")), "labels")
