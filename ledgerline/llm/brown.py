"""Brown class-based bigrams: exchange clustering, and log-probabilities of whole texts.

Words fall into classes; a text's probability is that of its class transitions
times that of each word within its class.  Classes are found by exchange: a unit
leaves its class and goes where the likelihood of the corpus gains most.  The
units are at first the frequent words, one each, and groups of the other words by
their last letters; then each of the other words leaves its group and is moved by
its own contexts.  Classes and emission counts are exact for every word: those of
the more frequent ones are sent to all tasks, bounded in number, and those of
all others are joined.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ledgerline.llm.common import discard, map_batches, signed, written

SUFFIX_BITS = 10
SUFFIXES = 1 << SUFFIX_BITS
SMOOTH = 0.1
#: Exchange ends where a sweep raises the log-likelihood by less than this share of what the classes explain.
TOLERANCE = 1e-3
#: Gains that differ by less than this share are equal but for rounding; a unit stays then.
NOISE = 1e-10
#: Words whose gains are added up at a time, and kinds of neighbours, class and times, whose gains are kept at a time.
TOGETHER, KINDS = 256, 8_192
#: A sweep that loses, for tasks move units at the same time, is done again in twice the parts, up to so many.
PARTS = 16


def word_hash(word: bytes) -> int:
    """54 bits of a hash of the word, then ten of its last three bytes."""
    return (xxhash.xxh3_64_intdigest(word) & ~(SUFFIXES - 1)) | (zlib.crc32(word[-3:]) & (SUFFIXES - 1))


#: No word is empty, so this is the end's alone.
END = word_hash(b"")


#: Constants of XXH3 for texts of up to 32 bytes: three multipliers, and the words of its secret, combined as it does.
XX_MIX, XX_SHORT = np.uint64(0x165667919E3779F9), np.uint64(0x9FB21C651E98DF25)
XX_TINY = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
XX_PRIME = np.uint64(0x9E3779B185EBCA87)
_SECRET = bytes.fromhex("b8fe6c3923a44bbe7c01812cf721ad1cded46de9839097db7240a4a4b7b3671fcb79e64eccc0e578825ad07dccff7221b8084674f743248ee03590e6813a264c")
_S4, _S8 = np.frombuffer(_SECRET, "<u4"), np.frombuffer(_SECRET, "<u8")
#: Longest word that is hashed in columns; and words that are hashed together, so that their columns stay in the cache.
COLUMNS, HASHED = 32, 1 << 15

def _crc_steps() -> np.ndarray:
    """The table of CRC-32: what a byte makes of a remainder of zero."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table.astype(np.uint32)


_CRC = _crc_steps()


def _u(x: int) -> np.uint64:
    return np.uint64(x)


def _fold(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Both halves of the 128-bit product, one exclusive-or the other."""
    low, half = _u(0xFFFFFFFF), _u(32)
    a0, a1, b0, b1 = a & low, a >> half, b & low, b >> half
    mid = a1 * b0 + (a0 * b0 >> half)
    high = a1 * b1 + (mid >> half) + ((a0 * b1 + (mid & low)) >> half)
    return high ^ (a * b)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _u(37))) * XX_MIX
    return h ^ (h >> _u(32))


def _column_hashes(eights: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """`word_hash` of the words of 1 to 32 bytes at some places of bytes, given as 64-bit numbers; a place is 8 at least."""

    def read(at: np.ndarray) -> np.ndarray:
        """The eight bytes from each place on."""
        k, shift = at >> 3, ((at & 7) << 3).astype(np.uint64)
        return (eights[k] >> shift) | ((eights[k + 1] << _u(1)) << (_u(63) - shift))

    first, last, n = read(start), read(start + size - 8), size.astype(np.uint64)
    out = np.empty(len(start), np.uint64)
    at = np.flatnonzero(size <= 3)
    if len(at):
        f, k = first[at], n[at]
        h = ((f & _u(255)) << _u(16)) | (((f >> ((k >> _u(1)) << _u(3))) & _u(255)) << _u(24)) | (last[at] >> _u(56)) | (k << _u(8))
        h ^= _u(int(_S4[0] ^ _S4[1]))
        h = (h ^ (h >> _u(33))) * XX_TINY[0]
        h = (h ^ (h >> _u(29))) * XX_TINY[1]
        out[at] = h ^ (h >> _u(32))
    at = np.flatnonzero((size > 3) & (size <= 8))
    if len(at):
        h = ((last[at] >> _u(32)) + (first[at] << _u(32))) ^ _S8[1] ^ _S8[2]
        h ^= ((h << _u(49)) | (h >> _u(15))) ^ ((h << _u(24)) | (h >> _u(40)))
        h *= XX_SHORT
        h = (h ^ ((h >> _u(35)) + n[at])) * XX_SHORT
        out[at] = h ^ (h >> _u(28))
    at = np.flatnonzero((size > 8) & (size <= 16))
    if len(at):
        low, high = first[at] ^ _S8[3] ^ _S8[4], last[at] ^ _S8[5] ^ _S8[6]
        out[at] = _finish(n[at] + low.byteswap() + high + _fold(low, high))
    at = np.flatnonzero(size > 16)
    if len(at):
        here, end = start[at], start[at] + size[at]
        h = n[at] * XX_PRIME + _fold(first[at] ^ _S8[0], read(here + 8) ^ _S8[1])
        out[at] = _finish(h + _fold(read(end - 16) ^ _S8[2], last[at] ^ _S8[3]))
    # The ten bits of the last three bytes, or of all where there are fewer.
    crc = np.full(len(start), 0xFFFFFFFF, np.uint32)
    for k in (3, 2, 1):
        byte = (last >> _u(64 - 8 * k)).astype(np.uint32) & np.uint32(255)
        step = _CRC[(crc ^ byte) & np.uint32(255)] ^ (crc >> np.uint32(8))
        crc = step if k == 1 else np.where(size >= k, step, crc)
    return (out & ~_u(SUFFIXES - 1)) | ((~crc).astype(np.uint64) & _u(SUFFIXES - 1))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text closed by an end, and where each text's tokens end."""
    lowered = pc.ascii_lower(pc.fill_null(column.cast(pa.string()), ""))
    offsets = np.frombuffer(lowered.buffers()[1], np.int32, len(lowered) + 1, 4 * lowered.offset).astype(np.int64) if len(lowered) else np.zeros(1, np.int64)
    size = int(offsets[-1] - offsets[0])
    # Eight bytes before the texts and sixteen behind them, so that whole numbers are read everywhere.
    padded = np.full((size + 31) & ~7, 32, np.uint8)
    if size:
        padded[8 : 8 + size] = np.frombuffer(lowered.buffers()[2], np.uint8, size, int(offsets[0]))
    space = _SPACE[padded[: size + 9]]
    # Where a text begins a word ends, whatever its sign.
    cut = space[:-1] | space[1:]
    begins = offsets - offsets[0] + 8
    cut[begins - 1] = True
    edges = np.flatnonzero(cut)
    # A word lies between two edges next to each other in whose middle there is no space.
    inside = ~space[edges[:-1] + 1]
    start, length = edges[:-1][inside] + 1, np.diff(edges)[inside]
    texts_at = np.searchsorted(start, begins)
    eights, found = padded.view(np.uint64), np.empty(len(start), np.uint64)
    for k in range(0, len(start), HASHED):
        part = slice(k, k + HASHED)
        found[part] = _column_hashes(eights, start[part], length[part])
    for k in np.flatnonzero(length > COLUMNS).tolist():
        found[k] = word_hash(padded[start[k] : start[k] + length[k]].tobytes())
    ends = texts_at[1:] + np.arange(1, len(offsets))
    out = np.empty(len(found) + len(column), np.uint64)
    word = np.ones(len(out), bool)
    word[ends - 1] = False
    out[word], out[ends - 1] = found, END
    return out, ends


def training_tokens(batch: pa.RecordBatch) -> np.ndarray:
    """Tokens of the texts of a batch that are learned from, one text after the other."""
    learned = pa.array([not held_out(d) for d in batch.column(0).to_pylist()], pa.bool_())
    return tokens_of(batch.column(1).filter(learned))[0]


def held_out(doc_id: int | None) -> bool:
    """One document in ten is not trained on; one without an id is not either."""
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 == 0


def places(sorted_hashes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each hash among the sorted ones, -1 where it is missing."""
    if not len(sorted_hashes):
        return np.full(len(hashes), -1)
    # Hashes are spread evenly: their first bits tell where to look, and a step or two more where there are several.
    bits = len(sorted_hashes).bit_length()
    shift = _u(64 - bits)
    first = np.searchsorted(sorted_hashes, np.arange(1 << bits, dtype=np.uint64) << shift)
    at = np.minimum(first, len(sorted_hashes) - 1)[hashes >> shift]
    there = sorted_hashes[at]
    out = np.where(there == hashes, at, -1)
    left = np.flatnonzero(there < hashes)
    while len(left):
        next_at = at[left] + 1
        left, next_at = left[next_at < len(sorted_hashes)], next_at[next_at < len(sorted_hashes)]
        at[left], there, wanted = next_at, sorted_hashes[next_at], hashes[left]
        out[left[there == wanted]] = next_at[there == wanted]
        left = left[there < wanted]
    return out


def units_of(frequent: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A frequent word is its own unit, another one belongs to that of its last letters."""
    at = places(frequent, hashes)
    return np.where(at >= 0, at, len(frequent) + (hashes & np.uint64(SUFFIXES - 1)).astype(np.int64))


def _g(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(counts: np.ndarray, right: np.ndarray, left: np.ndarray, own: float, now: int) -> int:
    """Move a unit to the class where the likelihood gains most; `counts` follow, the new class is returned.

    `right` and `left` count the classes after and before the unit's tokens,
    `own` the pairs of the unit with itself, `counts` all class pairs, the unit
    being in class `now`.  The gain is that of sum g(pairs) - sum g(starts) -
    sum g(ends) with g(x) = x log x, the unit taken out first.
    """
    # The tokens of a class, whatever stands beside them.
    starts, ends = counts.sum(axis=1), counts.sum(axis=0)
    starts[now] -= right.sum()
    ends[now] -= left.sum()
    counts[now] -= right
    counts[:, now] -= left
    counts[now, now] += own
    # Pairs with itself are no fixed context: they move along.
    right[now] -= own
    left[now] -= own
    across, down = np.flatnonzero(right), np.flatnonzero(left)
    gain = (_g(counts[:, across] + right[across]) - _g(counts[:, across])).sum(axis=1)
    gain += (_g(counts[down] + left[down][:, None]) - _g(counts[down])).sum(axis=0)
    corner = np.diagonal(counts)
    gain += _g(corner + right + left + own) - _g(corner + right) - _g(corner + left) + _g(corner)
    gain -= _g(starts + right.sum() + own) - _g(starts)
    gain -= _g(ends + left.sum() + own) - _g(ends)
    new = int(gain.argmax()) if gain.max() > gain[now] + NOISE * (1 + abs(gain[now])) else now
    counts[new] += right
    counts[:, new] += left
    counts[new, new] += own
    return new


def best_classes(
    counts: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray, now: np.ndarray
) -> np.ndarray:
    """The class that `exchange` finds for each of many words, all taken out of the same `counts` one at a time.

    `right` and `left` have a row a word.  Only what a word meets is looked at: what each class gains by a neighbour's class
    met so many times is worked out once for all words, and a word's gains are sums of such rows.  Where a word is in its
    neighbour's class, or in the class that is looked at, it is taken out of single counts.  Rows are added up for a few
    words at a time.
    """
    if len(now) > TOGETHER:
        # Most words are met once; those of one class between neighbours of the same classes go the same way.
        once = (own == 0) & (right.sum(axis=1) == 1) & (left.sum(axis=1) == 1)
        numbers = np.arange(len(counts), dtype=np.float64)
        kind = ((now * len(counts) + right @ numbers) * len(counts) + left @ numbers).astype(np.int64)
        _, first, alike = np.unique(np.where(once, kind, -1 - np.arange(len(now))), return_index=True, return_inverse=True)
        if len(first) < len(now):
            return best_classes(counts, right[first], left[first], own[first], now[first])[alike]
    rows, classes, logs = np.arange(len(now)), len(counts), _g(counts)
    stay, sides, spots, values = np.zeros(len(now)), [], [], []
    for mine, other, table, log in ((right, left, counts, logs), (left, right, counts.T, logs.T)):
        cells = np.flatnonzero(mine.ravel() != 0)
        word, met = np.divmod(cells, classes)
        here, times = now[word], mine.ravel()[cells]
        add = times - np.where(met == here, own[word], 0)
        kinds, kind = np.unique(add.astype(np.int64) * classes + met, return_inverse=True)
        if len(kinds) > KINDS and len(now) > TOGETHER:
            parts = zip(*(np.array_split(x, 2) for x in (right, left, own, now)))
            return np.concatenate([best_classes(counts, *part) for part in parts])
        base = table.T[kinds % classes]
        change = np.zeros((len(kinds) + 1, classes))
        change[:-1] = _g(base + (kinds // classes)[:, None]) - log.T[kinds % classes]
        # The last row is for words that meet nothing.
        lead, begin = np.full(len(now), len(kinds)), np.ones(len(word), bool)
        begin[1:] = word[1:] != word[:-1]
        lead[word[begin]] = kind[begin]
        sides.append((change, lead, word[~begin], kind[~begin]))
        # What the word's own class has without it.
        apart = met != here
        stay += np.bincount(word[apart], log[here[apart], met[apart]] - _g((table[here, met] - times)[apart]), len(now))
        at, same, more = word[~apart], here[~apart], add[~apart]
        base = table[same, same] - times[~apart] - other[at, same] + own[at]
        stay[at] += _g(base + more) - _g(base)
        # The pairs of its own class with those that the word has on its other side.
        k, far = np.nonzero(other[at])
        k, far = k[far != same[k]], far[far != same[k]]
        base = table[far, same[k]] - other[at[k], far]
        spots.append(at[k] * classes + far)
        values.append(_g(base + more[k]) - _g(base) - change[kind[~apart][k], far])
    out, into = right.sum(axis=1), left.sum(axis=1)
    starts, ends = counts.sum(axis=1), counts.sum(axis=0)
    wide = int(into.max(initial=0)) + 1
    amounts, amount = np.unique(out.astype(np.int64) * wide + into.astype(np.int64), return_inverse=True)
    lost = _g(starts) - _g(starts + (amounts // wide)[:, None]) + _g(ends) - _g(ends + (amounts % wide)[:, None])
    for total, moved in ((starts, out), (ends, into)):
        stay += _g(total[now] - moved) - _g(total[now])
    spots, values = np.concatenate(spots), np.concatenate(values)
    order = np.argsort(spots, kind="stable")
    spots, values = spots[order], values[order]
    new = np.empty(len(now), np.int64)
    for low in range(0, len(now), TOGETHER):
        here, size = now[low : low + TOGETHER], len(now[low : low + TOGETHER])
        part, at = slice(low, low + size), rows[:size]
        gain = lost[amount[part]]
        for change, lead, word, kind in sides:
            gain += change[lead[part]]
            more = slice(*np.searchsorted(word, (low, low + size)))
            has, first = np.unique(word[more], return_index=True)
            if len(has):
                gain[has - low] += np.add.reduceat(change[kind[more]], first, axis=0)
        more = slice(*np.searchsorted(spots, (low * classes, (low + size) * classes)))
        gain += np.bincount(spots[more] - low * classes, values[more], size * classes).reshape(size, classes)
        # The pairs of a class with itself change together only where a word meets it on both sides, or meets itself.
        after, before = right[part].copy(), left[part].copy()
        after[at, here] -= own[part]
        before[at, here] -= own[part]
        word, met = np.divmod(np.flatnonzero((after != 0) & (before != 0) | (own[part] != 0)[:, None]), classes)
        inside = met == here[word]
        corner = np.diagonal(counts)[met] + np.where(inside, (own[part] - right[part][at, here] - left[part][at, here])[word], 0)
        a, b, self = after[word, met], before[word, met], own[part][word]
        both = _g(corner + a + b + self) - _g(corner + a) - _g(corner + b) + _g(corner)
        gain[word, met] += both
        rest = stay[part]
        rest[word[inside]] += both[inside]
        gain[at, here] = rest
        best = gain.argmax(axis=1)
        new[part] = np.where(gain[at, best] > rest + NOISE * (1 + np.abs(rest)), best, here)
    return new


def _add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add each of the rows to the table's row at its place; places repeat."""
    order = np.argsort(at, kind="stable")
    places, first = np.unique(at[order], return_index=True)
    if len(places):
        table[places] += np.add.reduceat(rows[order], first, axis=0)


def explained(counts: np.ndarray) -> float:
    """What the classes add to the log-likelihood of the corpus: the part of it that exchange can change."""
    counts = counts.astype(np.float64)
    return float(_g(counts).sum() - _g(counts.sum(axis=1)).sum() - _g(counts.sum(axis=0)).sum() + _g(counts.sum()))


@dataclass(frozen=True)
class Model:
    """What a task needs: counts and classes of the head words, classes of the units, and log10 tables."""

    head: np.ndarray
    head_log: np.ndarray
    head_class: np.ndarray
    frequent: np.ndarray
    unit_class: np.ndarray
    transition: np.ndarray
    below: np.ndarray
    n: int
    v: int
    #: Tokens of each of the head words, at least.
    least: int


def _pairs_with(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(prev, next, n) of the units of training texts; a text starts after an end."""
    units = len(frequent) + SUFFIXES
    schema = pa.schema([("prev", pa.int32()), ("next", pa.int32()), ("n", pa.int64())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        end = np.array([END], np.uint64)
        unit = units_of(frequent, np.concatenate([end, training_tokens(batch)]))
        key, n = np.unique(unit[:-1] * units + unit[1:], return_counts=True)
        yield pa.record_batch([pa.array((key // units).astype(np.int32)), pa.array((key % units).astype(np.int32)), pa.array(n)], schema=schema)

    return map_batches(docs, work, schema).groupBy("prev", "next").agg(F.sum("n").alias("n"))


def _exchange(pairs: DataFrame, sizes: np.ndarray, classes: int, passes: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Class of each unit, and the counts of class pairs.

    A unit's neighbours are units, so its row is bounded by their number.  Each
    pass moves half of the units, or a smaller part after one that lost, one after the other within a task; what tasks
    move meanwhile they learn of before the next pass.  The driver holds the
    class of each unit and the class pairs, both of a bounded size.  Passes end
    where a sweep of them gains less than TOLERANCE, or after `passes`.
    """
    units = len(sizes)
    side = [
        pairs.select(F.col(a).alias("unit"), F.lit(k).alias("side"), F.col(b).alias("other"), "n")
        for k, (a, b) in enumerate((("prev", "next"), ("next", "prev")))
    ]
    contexts = written(
        side[0].unionByName(side[1]).groupBy("unit").agg(
            *[
                F.collect_list(F.when(F.col("side") == k, F.struct("other", "n"))).alias(name)
                for k, name in enumerate(("after", "before"))
            ]
        ).select("unit", "after.other", "after.n", F.col("before.other").alias("other_before"), F.col("before.n").alias("n_before")),
        "contexts",
    )
    assigned = np.empty(units, np.int64)
    assigned[np.argsort(-sizes, kind="stable")] = np.arange(units) % classes
    counts = _class_pairs(contexts, assigned, classes)
    out = pa.schema([("unit", pa.int32()), ("class", pa.int32())])
    parts, calm = 2, 0
    for turn in itertools.count():
        if turn == passes or calm == parts:
            return assigned, counts

        def move(batch: pa.RecordBatch, assigned=assigned, counts=counts, parts=parts, turn=turn) -> Iterator[pa.RecordBatch]:
            rows, assigned, counts = [], assigned.copy(), counts.astype(np.float64)
            for unit, after, n, before, n_before in zip(*batch.columns):
                u = unit.as_py()
                if (zlib.crc32(str(u).encode()) + turn) % parts:
                    continue
                after, before = after.values.to_numpy(), before.values.to_numpy()
                n, n_before = n.values.to_numpy(), n_before.values.to_numpy()
                right = np.bincount(assigned[after], n, classes)
                left = np.bincount(assigned[before], n_before, classes)
                assigned[u] = exchange(counts, right, left, float(n[after == u].sum()), int(assigned[u]))
                rows.append((u, int(assigned[u])))
            columns = list(zip(*rows)) or [(), ()]
            yield pa.record_batch([pa.array(c, pa.int32()) for c in columns], schema=out)

        moved = map_batches(contexts, move, out).toArrow()
        trial = assigned.copy()
        trial[moved.column("unit").to_numpy()] = moved.column("class").to_numpy()
        after = _class_pairs(contexts, trial, classes)
        gain = explained(after) - explained(counts)
        if gain < 0 and parts < PARTS:
            parts, calm = 2 * parts, 0
            continue
        calm = calm + 1 if gain <= TOLERANCE / parts * abs(explained(after)) else 0
        if gain > 0:
            assigned, counts = trial, after


def _class_pairs(contexts: DataFrame, assigned: np.ndarray, classes: int) -> np.ndarray:
    """Counts of class pairs; one small matrix per task is added up."""
    out = pa.schema([("key", pa.int32()), ("n", pa.int64())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        total = np.zeros(classes * classes, np.int64)
        for unit, after, n in zip(*batch.columns):
            keys = assigned[unit.as_py()] * classes + assigned[after.values.to_numpy()]
            total += np.bincount(keys, n.values.to_numpy(), classes * classes).astype(np.int64)
        key = np.flatnonzero(total)
        yield pa.record_batch([pa.array(key.astype(np.int32)), pa.array(total[key])], schema=out)

    summed = map_batches(contexts.select("unit", "other", "n"), work, out).groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(classes * classes, np.int64)
    counts[summed.column("key").to_numpy()] = summed.column("n").to_numpy()
    return counts.reshape(classes, classes)


#: Sweeps over the words that are not frequent, at most, and the kinds of keys that their contexts have: the class of a
#: frequent word after the word and of another one, of a frequent word before it and of another one, and the word itself.
SWEEPS = 6
NEXT, NEXT_RARE, PREV, PREV_RARE, ITSELF = range(5)


#: Bits of a packed pair that hold its key; n has the others.
KEY_BITS = 16
#: Words that are moved at a time, at most, and words after which a task goes on from the common counts.
PIECE, BATCH = 2_048, 10_000


def packed(lengths: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.Array:
    """Pairs of a key and n as bytes, so many for each row."""
    entries = np.ascontiguousarray(n.astype(np.int64) << KEY_BITS | key)
    ends = np.concatenate([[0], np.cumsum(8 * lengths, dtype=np.int64)])
    offsets = pa.py_buffer(ends.astype(np.int32))
    if ends[-1] >> 31:
        raise ValueError("a batch has too many contexts")
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets, pa.py_buffer(entries)])


def unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, key and n of all pairs of a column of packed pairs, or of lists of those; a missing row has none."""
    if pa.types.is_list(column.type):
        lists = pc.list_value_length(column)
        values = column.flatten()
        row = np.repeat(np.arange(len(column)), pc.fill_null(lists, 0).to_numpy())
    else:
        values, row = column, np.arange(len(column))
    lengths = pc.fill_null(pc.binary_length(values), 0).to_numpy() // 8
    entries = np.frombuffer(b"".join(values.drop_null().to_pylist()), np.int64)
    return np.repeat(row, lengths), entries & ((1 << KEY_BITS) - 1), entries >> KEY_BITS


#: Words of a row of packed words, and pairs that they have, about.
ROW_WORDS, ROW_PAIRS = 64, 512
#: Words, and tokens, of a bucket that rare words are dealt into by their hash, as powers of two, about; rows of packed
#: words that are worked on at a time.
BUCKET_WORDS, BUCKET_TOKENS = 12, 17
ROWS = 1_024


def blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Consecutive values as bytes, those up to the next end in each row."""
    offsets = np.concatenate([[0], ends]) * values.itemsize
    if offsets[-1] >> 31:
        raise ValueError("a batch has too many contexts")
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.astype(np.int32)), data])


def flat(column: pa.Array | pa.ChunkedArray, kind: type = np.int64) -> np.ndarray:
    """The values of all rows of a column made by `blobs`."""
    return np.frombuffer(b"".join(column.drop_null().to_pylist()), kind)


def buckets_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The first bits of signed hashes, which are even; so sorted hashes have sorted buckets."""
    return ((hashes >> 1) >> (63 - bits)).astype(np.int32)


def _rare_contexts(docs: DataFrame, frequent: np.ndarray, assigned: np.ndarray, classes: int, bits: int) -> DataFrame:
    """What the words that are not frequent meet in training texts, from one scan, a row for each portion and bucket.

    First (bucket, h, lengths, met): hashes, and packed pairs of a key and n for each, the key being a kind of neighbour times
    `classes` and its class, that of its group for a word that is not frequent.
    Then (bucket, prev, next, n) where neither word is frequent, by the bucket of the first.
    """
    bytes_ = ("h", "lengths", "met", "prev", "next", "n")
    schema = pa.schema([("bucket", pa.int32()), *((name, pa.binary()) for name in bytes_)])
    keys = ITSELF * classes + 1

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        end = np.array([END], np.uint64)
        words = np.concatenate([end, training_tokens(batch)])
        unit = units_of(frequent, words)
        kind, known = assigned[unit], unit < len(frequent)
        rare = np.flatnonzero(~known)
        names, number = np.unique(words[rare].view(np.int64), return_inverse=True)
        code = np.zeros(len(words), np.int64)
        code[rare] = number
        p, q, same = ~known[:-1], ~known[1:], words[:-1] == words[1:]
        after, before, itself = np.flatnonzero(p & ~same), np.flatnonzero(q & ~same), np.flatnonzero(p & same)
        met = np.concatenate(
            [
                code[after] * keys + np.where(known[after + 1], NEXT, NEXT_RARE) * classes + kind[after + 1],
                code[before + 1] * keys + np.where(known[before], PREV, PREV_RARE) * classes + kind[before],
                code[itself] * keys + ITSELF * classes,
            ]
        )
        key, n = np.unique(met, return_counts=True)
        word, key = np.divmod(key, keys)
        lengths = np.bincount(word, minlength=len(names))
        bucket, ends = np.unique(buckets_of(names, bits), return_counts=True)
        ends, none = np.cumsum(ends), pa.nulls(len(bucket), pa.binary())
        pairs = np.cumsum(lengths)[ends - 1]
        columns = [blobs(names, ends), blobs(lengths.astype(np.int32), ends), blobs(n << KEY_BITS | key, pairs)]
        yield pa.record_batch([pa.array(bucket), *columns, none, none, none], schema=schema)
        both = np.flatnonzero(p & q)
        key, n = np.unique(code[both] * max(len(names), 1) + code[both + 1], return_counts=True)
        first, second = names[key // max(len(names), 1)], names[key % max(len(names), 1)]
        bucket, ends = np.unique(buckets_of(first, bits), return_counts=True)
        ends, none = np.cumsum(ends), pa.nulls(len(bucket), pa.binary())
        columns = [blobs(x, ends) for x in (first, second, n.astype(np.int32))]
        yield pa.record_batch([pa.array(bucket), none, none, none, *columns], schema=schema)

    return written(map_batches(docs, work, schema), "rare-contexts")


#: A row of packed words: their bucket, hashes, numbers of packed pairs, packed pairs and classes; and, in the last row that a
#: task wrote at a time, what class pairs gained or lost by the moves that led to these classes, packed as well.
STATE = pa.schema(
    [("bucket", pa.int32()), ("h", pa.binary()), ("lengths", pa.binary()), ("met", pa.binary()), ("class", pa.binary()), ("moved", pa.binary())]
)


def _first_state(contexts: DataFrame, group_class: np.ndarray, classes: int) -> DataFrame:
    """All words that are not frequent, with all they meet, in the classes of their groups."""
    keys = ITSELF * classes + 1

    def merge(rows: pa.Table) -> pa.Table:
        names, number = np.unique(flat(rows.column("h")), return_inverse=True)
        entries = flat(rows.column("met"))
        word = np.repeat(number, flat(rows.column("lengths"), np.int32))
        pair, at = np.unique(word * keys + (entries & ((1 << KEY_BITS) - 1)), return_inverse=True)
        word, key = np.divmod(pair, keys)
        n = np.bincount(at, entries >> KEY_BITS, len(pair)).astype(np.int64)
        lengths = np.bincount(word, minlength=len(names))
        pairs, place = np.cumsum(lengths), np.arange(len(names))
        # A row ends after so many words, or where they have met enough.
        page = (pairs - lengths) // ROW_PAIRS
        ends = 1 + np.flatnonzero(np.append((page[1:] != page[:-1]) | (place[1:] % ROW_WORDS == 0), True))
        columns = [
            blobs(names, ends),
            blobs(lengths.astype(np.int32), ends),
            blobs(n << KEY_BITS | key, pairs[ends - 1]),
            blobs(group_class[names & (SUFFIXES - 1)].astype(np.int16), ends),
        ]
        bucket = pa.array(np.full(len(ends), rows.column("bucket")[0].as_py(), np.int32))
        return pa.Table.from_arrays([bucket, *columns, pa.nulls(len(ends), pa.binary())], schema=STATE)

    return written(contexts.groupBy("bucket").applyInArrow(merge, from_arrow_schema(STATE)), "rare-words")


@dataclass(frozen=True)
class Words:
    """Packed words of some rows: hashes, classes, and where the pairs of each word begin among all of them."""

    h: np.ndarray
    now: np.ndarray
    begin: np.ndarray
    entries: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> Words:
        begin = np.concatenate([[0], np.cumsum(flat(batch.column(2), np.int32), dtype=np.int64)])
        return Words(flat(batch.column(1), np.uint64), flat(batch.column(4), np.int16).astype(np.int64), begin, flat(batch.column(3)))

    def pairs(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, key and n of what some of the words meet; the first of them has number 0."""
        entries = self.entries[self.begin[low] : self.begin[high]]
        word = np.repeat(np.arange(high - low), np.diff(self.begin[low : high + 1]))
        return word, entries & ((1 << KEY_BITS) - 1), entries >> KEY_BITS


def _in_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, ROWS):
        yield batch.slice(at, ROWS)


def _spread(
    docs: DataFrame, frequent: np.ndarray, assigned: np.ndarray, counts: np.ndarray, bits: int
) -> tuple[DataFrame, np.ndarray]:
    """(h, c, class) of all words that are not frequent, and the counts of class pairs.

    A word starts in the class of its group and goes where the likelihood gains
    most by its own contexts.  While words move, frequent neighbours have their
    class and others that of their group; so contexts are gathered once, and a
    sweep is one pass over them, which also tells what class pairs gain and lose by it.  Sweeps end where one gains less
    than TOLERANCE; one that loses, for tasks move words at the same time, is not kept and done
    again with half of the words.  At the end all pairs are counted by the real
    classes on both sides; if those explain less than the groups did, the groups
    stay.
    """
    classes = len(counts)
    table = _rare_contexts(docs, frequent, assigned, classes, bits)
    contexts = table.filter("lengths IS NOT NULL").select("bucket", "h", "lengths", "met")
    out = pa.schema([("key", pa.int32()), ("n", pa.int64())])

    def sums(pair: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        summed = np.bincount(pair, n, classes * classes)
        key = np.flatnonzero(summed)
        return pa.record_batch([pa.array(key.astype(np.int32)), pa.array(summed[key].astype(np.int64))], schema=out)

    def matrix(pairs: DataFrame) -> np.ndarray:
        summed = pairs.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
        found = np.zeros(classes * classes, np.int64)
        found[summed.column("key").to_numpy()] = summed.column("n").to_numpy()
        return found.reshape(classes, classes)

    def class_pairs(key: np.ndarray, now: np.ndarray) -> np.ndarray:
        """The class pair of each pair that a word in class `now` makes by a key."""
        kind, other = np.divmod(key, classes)
        return np.where(kind == PREV, other * classes + now, now * classes + np.where(kind == ITSELF, now, other))

    def delta(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        entries = flat(batch.column(0))
        yield sums(entries & ((1 << KEY_BITS) - 1), entries >> KEY_BITS)

    def guessed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Class pairs of two words that are not frequent, as the sweeps took them."""
        for rows in _in_rows(batch):
            words = Words.of(rows)
            word, key, n = words.pairs(0, len(words.h))
            pair = class_pairs(key, words.now[word])
            wanted = (key // classes == NEXT_RARE) | (key // classes == ITSELF)
            yield sums(pair[wanted], n[wanted])

    state = first = _first_state(contexts, assigned[len(frequent) :], classes)
    start, parts = counts, 1
    for turn in range(SWEEPS):

        def move(batch: pa.RecordBatch, counts=counts.astype(np.float64), parts=parts, turn=turn) -> Iterator[pa.RecordBatch]:
            common, counts, size, done = counts, counts.copy(), 1, 0
            for rows in _in_rows(batch):
                words, low = Words.of(rows), 0
                classed, change = words.now.copy(), np.zeros(classes * classes)
                while low < len(words.h):
                    # The first piece has one word, the next one twice as many, until they are many.
                    if done == BATCH:
                        counts, size, done = common.copy(), 1, 0
                    high = min(low + min(size, BATCH - done), len(words.h))
                    now, size, done = words.now[low:high], min(2 * size, PIECE), done + high - low
                    word, key, n = words.pairs(low, high)
                    kind, at = key // classes, word * classes + key % classes
                    sides = (kind <= NEXT_RARE, (kind == PREV) | (kind == PREV_RARE))
                    right, left = (np.bincount(at[x], n[x], len(now) * classes).reshape(-1, classes) for x in sides)
                    own = np.bincount(word[kind == ITSELF], n[kind == ITSELF], len(now))
                    right[np.arange(len(now)), now] += own
                    left[np.arange(len(now)), now] += own
                    mine = np.flatnonzero(((words.h[low:high].view(np.int64) >> SUFFIX_BITS) + turn) % parts == 0)
                    new = now.copy()
                    new[mine] = best_classes(counts, right[mine], left[mine], own[mine], now[mine])
                    # What this piece moved, the next one knows.
                    went = np.flatnonzero(new != now)
                    for there, sign in ((now, -1), (new, 1)):
                        _add_rows(counts, there[went], sign * right[went])
                        _add_rows(counts.T, there[went], sign * left[went])
                    np.maximum(counts, 0, out=counts)
                    moved = (new != now)[word] & (kind != PREV_RARE)
                    word, key, n = word[moved], key[moved], n[moved]
                    for there, sign in ((now, -1), (new, 1)):
                        change += sign * np.bincount(class_pairs(key, there[word]), n, classes * classes)
                    classed[low:high], low = new, high
                key = np.flatnonzero(change)
                told = (change[key].astype(np.int64) << KEY_BITS | key).tobytes()
                ends = np.cumsum(pc.binary_length(rows.column(1)).to_numpy() // 8)
                told = pa.array([None] * (rows.num_rows - 1) + [told], pa.binary())
                yield pa.record_batch([*rows.columns[:4], blobs(classed.astype(np.int16), ends), told], schema=STATE)

        moved = written(map_batches(state, move, STATE), "rare-words")
        after = counts + matrix(map_batches(moved.filter("moved IS NOT NULL").select("moved"), delta, out))
        gain = explained(after) - explained(counts)
        if gain > 0:
            if state is not first:
                discard(state)
            state, counts = moved, after
        else:
            discard(moved)
            if gain < 0 and parts < PARTS:
                parts *= 2
                continue
        if gain <= TOLERANCE * abs(explained(counts)):
            break
    # By the real classes of both words, whatever the sweeps took for them.
    exact = counts - matrix(map_batches(state, guessed, out)) + matrix(_rare_pairs(table, state, classes, bits))
    kept = state if explained(exact) > explained(start) else first
    words = written(_rows_of(kept, classes), "rare-classes")
    discard(table)
    return words, exact if kept is state else start


def _rare_pairs(table: DataFrame, state: DataFrame, classes: int, bits: int) -> DataFrame:
    """(key, n): pairs of two words that are not frequent, by the classes of both; each is looked up in its bucket."""
    out = pa.schema([("key", pa.int32()), ("n", pa.int64())])
    half = pa.schema([("bucket", pa.int32()), ("next", pa.binary()), ("class", pa.binary()), ("n", pa.binary())])
    # Second words are dealt out by fewer bits, so that rows have several of them.
    coarse = max(bits - 4, 0)

    def classes_of(words: pa.Table, hashes: np.ndarray, bits: int) -> np.ndarray:
        """Classes of some words of a bucket; the bits that all of its hashes share tell nothing of their places."""
        h, kind = flat(words.column("h"), np.uint64) << _u(bits), flat(words.column("class"), np.int16)
        order = np.argsort(h)
        return kind[order][places(h[order], hashes << _u(bits))]

    def of_first(words: pa.Table, pairs: pa.Table) -> pa.Table:
        kind = classes_of(words, flat(pairs.column("prev"), np.uint64), bits) if pairs.num_rows else np.empty(0, np.int16)
        second, n = flat(pairs.column("next")), flat(pairs.column("n"), np.int32)
        order = np.argsort(second)
        bucket, ends = np.unique(buckets_of(second[order], coarse), return_counts=True)
        columns = [blobs(x[order], np.cumsum(ends)) for x in (second, kind, n)]
        return pa.Table.from_arrays([pa.array(bucket), *columns], schema=half)

    def of_second(words: pa.Table, pairs: pa.Table) -> pa.Table:
        total = np.zeros(classes * classes, np.int64)
        if pairs.num_rows:
            second = classes_of(words, flat(pairs.column("next"), np.uint64), coarse).astype(np.int64)
            key = flat(pairs.column("class"), np.int16).astype(np.int64) * classes + second
            total = np.bincount(key, flat(pairs.column("n"), np.int32), classes * classes).astype(np.int64)
        key = np.flatnonzero(total)
        return pa.Table.from_arrays([pa.array(key.astype(np.int32)), pa.array(total[key])], schema=out)

    known = state.select("bucket", "h", "class")
    pairs = table.filter("prev IS NOT NULL").select("bucket", "prev", "next", "n")
    found = known.groupBy("bucket").cogroup(pairs.groupBy("bucket")).applyInArrow(of_first, from_arrow_schema(half))
    wide = known.withColumn("bucket", F.shiftright("bucket", bits - coarse))
    return wide.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(of_second, from_arrow_schema(out))


def _rows_of(state: DataFrame, classes: int) -> DataFrame:
    """(h, c, class): a row for each of the packed words; each of its tokens has one after it."""
    schema = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("class", pa.int32())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows in _in_rows(batch):
            words = Words.of(rows)
            word, key, n = words.pairs(0, len(words.h))
            kind = key // classes
            c = np.bincount(word, np.where((kind == PREV) | (kind == PREV_RARE), 0, n), len(words.h))
            columns = [words.h.view(np.int64), c.astype(np.int64), words.now.astype(np.int32)]
            yield pa.record_batch([pa.array(x) for x in columns], schema=schema)

    return map_batches(state, work, schema)


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, c): the hash and the count of every token of the training texts."""
    schema = pa.schema([("h", pa.int64()), ("n", pa.int64())])

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        h, n = np.unique(training_tokens(batch), return_counts=True)
        yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(n)], schema=schema)

    return map_batches(docs, work, schema).groupBy("h").agg(F.sum("n").alias("c"))


def fit(
    docs: DataFrame, counts: DataFrame, classes: int, passes: int | None, head_bits: int, unit_bits: int
) -> tuple[Model, DataFrame]:
    """The model, and (h, c, class) of the words that are not frequent."""
    # Of N tokens no more than the root of 2 N different counts are made.
    by_count = counts.groupBy("c").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("c")).toArrow()
    times, kinds = (by_count.column(k).to_numpy() for k in range(2))
    n, v = int((times * kinds).sum()), int(kinds.sum())
    enough = times[np.cumsum(kinds) <= 1 << head_bits]
    least = int(enough[-1]) if len(enough) else n + 1
    found = counts.filter((F.col("c") >= least) | (F.col("h") == signed(END))).toArrow()
    head, head_count = found.column("h").to_numpy().view(np.uint64), found.column("c").to_numpy()
    order = np.argsort(head)
    head, head_count = head[order], head_count[order]
    frequent = head[(head_count << unit_bits >= n) | (head == np.uint64(END))]
    units = len(frequent) + SUFFIXES
    # Tokens and distinct words of each unit: groups of words by their last letters are few.
    own = F.col("h").isin([int(x) for x in frequent.view(np.int64)]) if len(frequent) <= 256 else None
    sizes, kinds = np.zeros(units, np.int64), np.zeros(units, np.int64)
    sizes[: len(frequent)] = head_count[np.isin(head, frequent)]
    kinds[: len(frequent)] = 1
    if own is None:
        known = counts.sparkSession.createDataFrame(pa.table({"h": pa.array(frequent.view(np.int64))}))
        others = counts.join(F.broadcast(known), "h", "left_anti")
    else:
        others = counts.filter(~own)
    group = F.col("h").bitwiseAND(F.lit(SUFFIXES - 1)).cast("int").alias("group")
    for row in others.groupBy(group).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("k")).collect():
        sizes[len(frequent) + row["group"]], kinds[len(frequent) + row["group"]] = row["c"], row["k"]
    assigned, pairs = _exchange(_pairs_with(docs, frequent), sizes, classes, passes)
    bits = min(max(v >> BUCKET_WORDS, n >> BUCKET_TOKENS).bit_length(), 24)
    words, pairs = _spread(docs, frequent, assigned, pairs, bits)
    smoothed = pairs + SMOOTH
    known = len(frequent)
    class_n = np.bincount(assigned[:known], sizes[:known], classes)
    class_v = np.bincount(assigned[:known], kinds[:known], classes)
    for row in words.groupBy("class").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("k")).collect():
        class_n[row["class"]] += row["c"]
        class_v[row["class"]] += row["k"]
    head_class = assigned[units_of(frequent, head)]
    more = words.filter(F.col("c") >= least).select("h", "class").toArrow()
    head_class[places(head, more.column("h").to_numpy().view(np.uint64))] = more.column("class").to_numpy()
    model = Model(
        head,
        np.log10(head_count + SMOOTH),
        head_class.astype(np.int16),
        frequent,
        assigned,
        np.log10(smoothed / smoothed.sum(axis=1, keepdims=True)),
        np.log10(class_n + SMOOTH * (class_v + 1)),
        n,
        v,
        least,
    )
    return model, words


def score(
    docs: DataFrame, classes: int = 64, passes: int | None = None, head_bits: int = 20, unit_bits: int = 14
) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words stand between ASCII white space, in lower case (A-Z); an end closes a
    text.  NULL texts are empty and hold their end only.  A document is held out,
    that is, not learned from, if the CRC-32 of its id is divisible by ten or it
    has no id.  `base_score` is the sum of log10((c + 0.1) / (N + 0.1 (V + 1)))
    over the tokens; `score` is the class model's log10 probability, with the
    same smoothing of transitions and of words within a class, where one more
    word stands for all that were never seen.  Rows that repeat count and are
    scored each.  Without training texts all tokens are unknown.

    The 2**head_bits most frequent words, or fewer where counts are equal, are
    sent to every task, and units for the first exchange need 2**-unit_bits of all tokens; it
    has at most `passes` passes, if given.  All other training words are then moved
    each by its own contexts, in `SWEEPS` sweeps at most.  A word that was never seen has the class that the
    group of its last letters had before.
    """
    docs = docs.select("doc_id", "text")
    counts = written(word_counts(docs), "word-counts")
    model, words = fit(docs, counts, classes, passes, head_bits, unit_bits)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("held_out", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("known", pa.int64()),
            ("head_sum", pa.float64()),
            ("class_sum", pa.float64()),
            ("tail", pa.list_(pa.int64())),
            ("times", pa.list_(pa.int32())),
            ("from", pa.list_(pa.int32())),
            ("to", pa.list_(pa.int32())),
        ]
    )

    def local(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """All but the counts and moves of rarer words, which are listed: a class, or -1 and less for a place in `tail`."""
        end_class = model.unit_class[units_of(model.frequent, np.array([END], np.uint64))]
        ids = batch.column(0).to_pylist()
        h, ends = tokens_of(batch.column(1))
        starts = ends - np.diff(ends, prepend=0)
        row = np.repeat(np.arange(len(ids)), ends - starts)
        at = places(model.head, h)
        inside, rare = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        # The rarer words of each text, in the order of their hashes.
        order = rare[np.lexsort((h[rare], row[rare]))]
        new = np.ones(len(order), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (row[order][1:] != row[order][:-1])
        number, tail = np.cumsum(new) - 1, order[new]
        tails = np.searchsorted(row[tail], np.arange(len(ids) + 1))
        kind = np.empty(len(h), np.int64)
        kind[inside] = model.head_class[at[inside]]
        kind[order] = -1 - (number - tails[row[order]])
        first = np.concatenate([end_class, kind[:-1]])
        first[starts] = end_class
        known = (first >= 0) & (kind >= 0)
        open_moves = np.flatnonzero(~known)
        gained = np.zeros(len(h))
        gained[known] = model.transition[first[known], kind[known]]
        gained[inside] -= model.below[kind[inside]]
        listed = np.searchsorted(row[open_moves], np.arange(len(ids) + 1))
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([held_out(d) for d in ids], pa.bool_()),
            pa.array(ends - starts),
            pa.array(np.bincount(row[inside], minlength=len(ids))),
            pa.array(np.bincount(row[inside], model.head_log[at[inside]], len(ids))),
            pa.array(np.bincount(row, gained, len(ids))),
        ]
        for cuts, values in (
            (tails, h[tail].view(np.int64)),
            (tails, np.bincount(number, minlength=len(tail)).astype(np.int32)),
            (listed, first[open_moves].astype(np.int32)),
            (listed, kind[open_moves].astype(np.int32)),
        ):
            columns.append(pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values)))
        yield pa.record_batch(columns, schema=schema)

    rows = written(map_batches(docs, local, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = rows.select("row", F.explode(F.arrays_zip("tail", "times")).alias("t")).select("row", F.col("t.tail").alias("h"), F.col("t.times").alias("k"))
    # Without training texts not even the end is a head word.
    found = rare.join(words.filter(F.col("c") < model.least), "h", "left").withColumns({"c": F.coalesce("c", F.lit(0)), "class": F.coalesce("class", F.lit(-1))})
    per_row = found.groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.col("c") + F.lit(SMOOTH))).alias("tail_sum"),
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("tail_known"),
        F.collect_list(F.struct("h", "class")).alias("kinds"),
    )
    moved_schema = pa.schema([("row", pa.int64()), ("tail_sum", pa.float64()), ("tail_known", pa.int64()), ("moves", pa.float64())])

    def close(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Moves and emissions of the rarer words of each row."""
        at = np.arange(batch.num_rows)
        kinds, times, first, second = (batch.column(k).flatten() for k in (3, 5, 6, 7))
        words, moves = (np.repeat(at, pc.list_value_length(batch.column(k)).to_numpy()) for k in (3, 6))
        # A row's words in the order of their hashes, as the places in `tail` have it.
        own, kind = (x.to_numpy() for x in kinds.flatten())
        own = own.view(np.uint64)
        order = np.lexsort((own, words))
        own, kind = own[order], kind[order]
        kind = np.where(kind >= 0, kind, model.unit_class[units_of(model.frequent, own)])
        begin = np.searchsorted(words, at)[moves]
        a, b = (np.where(x >= 0, x, kind[begin + np.maximum(-1 - x, 0)]) for x in (first.to_numpy(), second.to_numpy()))
        gained = np.bincount(moves, model.transition[a, b], len(at)) - np.bincount(words, model.below[kind] * times.to_numpy(), len(at))
        yield pa.record_batch([*batch.columns[:3], pa.array(gained)], schema=moved_schema)

    lists = rows.select("row", "tail", "times", "from", "to").filter(F.size("tail") > 0)
    per_row = map_batches(
        per_row.join(lists, "row").select("row", "tail_sum", "tail_known", "kinds", "tail", "times", "from", "to"), close, moved_schema
    )
    zero = F.lit(0)
    emitted = F.col("head_sum") + F.coalesce("tail_sum", zero)
    below = float(np.log10(model.n + SMOOTH * (model.v + 1)))
    return rows.drop("tail", "times", "from", "to").join(per_row, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", zero)).alias("n_known"),
        F.lit(model.n).cast("bigint").alias("train_tokens"),
        (emitted - F.col("n_tokens") * below).alias("base_score"),
        (emitted + F.col("class_sum") + F.coalesce("moves", zero)).alias("score"),
    )
