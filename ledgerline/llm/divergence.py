"""How far the sources of a language differ in their words, counted exactly in two passes.

The first pass counts, for each term, the documents that hold it, and keeps the terms in enough of
them.  These get minimal perfect hashes in shards of some ten thousand terms, each shard of one
language.  The second pass has the shards sent to every task, a bundle of bounded size at a time: a
token's slot is looked up, checked against the stored term, and a dense counter per (language, source)
is incremented there.  Everything after that is integers over (language, source, slot).
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ledgerline.llm.common import written
from ledgerline.llm.perfect_hash import PerfectHash

#: Terms of a shard on average, bytes of the shards that one scan sends to every task, and bytes of
#: the counters that a task holds before it hands them on.
SHARD_TERMS, BUNDLE_BYTES, COUNTER_BYTES = 1 << 15, 64 << 20, 64 << 20

#: Distinct (language, term) pairs that a task counts before it hands them on.
COUNTED_TERMS = 1 << 18

#: Cells of (source, term) that one group of the pair distances may have, and terms at most.
CELLS, BLOCK_TERMS = 1 << 21, 2_048

#: ASCII letters and all that is not ASCII; in UTF-8 no byte of a longer character is ASCII.
_TERM = re.compile(rb"[a-z\x80-\xff]+")

_FREQUENCIES = pa.schema([("lang", pa.string()), ("term", pa.string()), ("n", pa.int64())])
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("slot", pa.int64()), ("n", pa.int64())])
_SHARDS = pa.schema(
    [("lang", pa.string()), ("shard", pa.int64()), ("slot", pa.int64()), ("term", pa.string()), ("packed", pa.binary())]
)


def terms_of(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())


def _strings(values) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of this task that hold a term, by language."""

    def counted(found: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counts in found.items():
            columns = [pa.array([lang] * len(counts), pa.string()), _strings(counts.keys()), pa.array(counts.values(), pa.int64())]
            yield pa.record_batch(columns, schema=_FREQUENCIES)

    found: dict[str, Counter] = defaultdict(Counter)
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            counts = found[lang]
            before = len(counts)
            counts.update(set(terms_of(text.as_py())))
            held += len(counts) - before
            if held > COUNTED_TERMS:
                yield from counted(found)
                found.clear()
                held = 0
    yield from counted(found)


def term_hashes(terms: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def _build(key: tuple, group: pa.Table) -> pa.Table:
    """The perfect hash of one shard, as a row, and a row per term with its slot."""
    lang, shard, shards = key[0].as_py(), key[1].as_py(), group.column("shards")[0].as_py()
    terms = group.column("term").combine_chunks().cast(pa.binary()).to_pylist()
    found = PerfectHash(terms, term_hashes(terms))
    n = len(terms)
    return pa.table(
        [
            pa.array([lang] * (n + 1), pa.string()),
            pa.array([shard] * (n + 1), pa.int64()),
            pa.array([*((shard << 32) + found.slots_of_input).tolist(), shards], pa.int64()),
            pa.concat_arrays([_strings(terms), pa.nulls(1, pa.string())]),
            pa.array([None] * n + [found.packed()], pa.binary()),
        ],
        schema=_SHARDS,
    )


def term_slots(kept: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The kept terms (lang, term) as shards: rows (lang, shard, slot, term), and a row for each shard with its `packed`
    hash and, as `slot`, the number of the language's shards.

    A term's shard follows from its own hash, so tasks find it without a list.
    """
    shards = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / shard_terms).alias("shards"))
    sharded = kept.join(shards, "lang").withColumn("shard", F.pmod(F.xxhash64("term"), "shards"))
    return written(sharded.groupBy("lang", "shard").applyInArrow(_build, from_arrow_schema(_SHARDS)), "shards")


class _Bundle:
    """The shards of one language that a scan has, their slots in a row."""

    def __init__(self, shards: int, packed: dict[int, bytes]):
        self.shards, self.tables, self.base, slots, base = shards, {}, {}, [], 0
        for shard, data in packed.items():
            self.tables[shard], self.base[shard] = PerfectHash.unpacked(data), base
            n = len(self.tables[shard])
            slots.append((shard << 32) + np.arange(n, dtype=np.int64))
            base += n
        self.slots = np.concatenate(slots)

    def places(self, terms: list[bytes]) -> np.ndarray:
        """Place of each term in the counters; -1 for a term that is not kept, or not in these shards."""
        shard = np.zeros(len(terms), np.int64)
        if self.shards > 1:
            own = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in terms), np.uint64, len(terms))
            shard = own.view(np.int64) % self.shards
        hashes, out = term_hashes(terms), np.full(len(terms), -1, np.int64)
        for at in np.unique(shard).tolist():
            if (table := self.tables.get(at)) is not None:
                mine = np.flatnonzero(shard == at)
                found = table.slots([terms[i] for i in mine.tolist()], hashes[mine])
                out[mine] = np.where(found >= 0, found + self.base[at], -1)
        return out


def _recount(batches: Iterator[pa.RecordBatch], sent, counter_bytes: int) -> Iterator[pa.RecordBatch]:
    """Occurrences of the sent terms in this task's rows, by (lang, source, slot)."""
    bundles = {lang: _Bundle(*parts) for lang, parts in sent.value.items()}
    dense: dict[tuple[str, str], np.ndarray] = {}
    held = 0

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in dense.items():
            at = np.flatnonzero(counts)
            names = [pa.array([name] * len(at), pa.string()) for name in (lang, source)]
            yield pa.record_batch([*names, pa.array(bundles[lang].slots[at]), pa.array(counts[at])], schema=_COUNTS)

    for batch in batches:
        tokens: dict[tuple[str, str], Counter] = defaultdict(Counter)
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
            if lang in bundles:
                tokens[lang, source].update(terms_of(text.as_py()))
        for group, found in tokens.items():
            bundle, terms = bundles[group[0]], list(found)
            places = bundle.places(terms)
            counts = np.fromiter(found.values(), np.int64, len(terms))
            known = places >= 0
            if group not in dense:
                if held + 8 * len(bundle.slots) > counter_bytes and dense:
                    yield from handed()
                    dense.clear()
                    held = 0
                dense[group] = np.zeros(len(bundle.slots), np.int64)
                held += 8 * len(bundle.slots)
            dense[group][places[known]] += counts[known]
    yield from handed()


def _bundles(shards: DataFrame, bundle_bytes: int) -> Iterator[dict[str, tuple[int, dict[int, bytes]]]]:
    """Shards by language with their number, as many at a time as may be sent to every task.

    The list that deals them out has a row per shard, some ten thousand terms.
    """
    packed = shards.filter("packed IS NOT NULL")
    place = Window.orderBy("lang", "shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = packed.select("lang", "shard", F.octet_length("packed").cast("bigint").alias("bytes"))
    dealt = sizes.withColumn("bundle", F.floor((F.sum("bytes").over(place) - 1) / bundle_bytes))
    dealt = written(dealt.select("lang", "shard", "bundle"), "bundles")
    for row in dealt.select("bundle").distinct().orderBy("bundle").toLocalIterator():
        mine = packed.join(F.broadcast(dealt.filter(F.col("bundle") == row["bundle"])), ["lang", "shard"])
        out: dict[str, tuple[int, dict[int, bytes]]] = {}
        for part in mine.select("lang", "shard", "slot", "packed").toLocalIterator():
            out.setdefault(part["lang"], (part["slot"], {}))[1][part["shard"]] = bytes(part["packed"])
        yield out


def recount(docs: DataFrame, shards: DataFrame, bundle_bytes: int = BUNDLE_BYTES, counter_bytes: int = COUNTER_BYTES) -> DataFrame:
    """(lang, source, slot, n) for every kept term with an occurrence, one scan of the documents per bundle."""
    spark = docs.sparkSession
    parts = [spark.createDataFrame([], from_arrow_schema(_COUNTS))]
    for at, bundle in enumerate(_bundles(shards, bundle_bytes)):
        sent = spark.sparkContext.broadcast(bundle)
        work = partial(_recount, sent=sent, counter_bytes=counter_bytes)
        counted = docs.mapInArrow(work, from_arrow_schema(_COUNTS)).groupBy("lang", "source", "slot").agg(F.sum("n").alias("n"))
        parts.append(written(counted, f"counts-{at}"))
        sent.unpersist()
    return reduce(DataFrame.unionByName, parts)


def _share(n: str, total: str, terms: str) -> str:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)) in decimals, which hold every product of two longs here."""
    above, below = f"CAST({n} AS DECIMAL(20,0)) + 5", f"CAST({total} AS DECIMAL(20,0)) + 5 * {terms}"
    return f"CAST(1 + (CAST(1000000000 AS DECIMAL(10,0)) * ({above})) div ({below}) AS BIGINT)"


def _distances(cells: pd.DataFrame) -> pd.DataFrame:
    """Sums of |p - q| over one block of terms for all pairs of sources; rows with slot -1 have a source's p of absent terms."""
    base = cells[cells["slot"] < 0].sort_values("sid")
    there = cells[cells["slot"] >= 0]
    sids = base["sid"].to_numpy()
    columns, terms = pd.factorize(there["slot"])
    p = np.repeat(base["p"].to_numpy()[:, None], max(len(terms), 1), axis=1)
    p[np.searchsorted(sids, there["sid"].to_numpy()), columns] = there["p"].to_numpy()
    out = [
        pd.DataFrame({"lang": base["lang"].iloc[0], "a": sids[i], "b": sids[i + 1 :], "value": np.abs(p[i + 1 :] - p[i]).sum(axis=1)})
        for i in range(len(sids) - 1)
    ]
    if not out or not len(terms):
        return pd.DataFrame({"lang": pd.Series(dtype=object), "a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64"), "value": pd.Series(dtype="int64")})
    return pd.concat(out, ignore_index=True)


def divergence(docs: DataFrame, least_docs: int = 30, first: int = 50, shard_terms: int = SHARD_TERMS, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): how far sources differ, and by which terms.

    NULL text, lang and source read as ''.  A language keeps the terms in `least_docs` of its
    documents.  p of a source and term is 1 + floor(10^9 (count + 5) / (N + 5 V)) over the V kept
    terms with N occurrences.  Part `pair`: for each other source of the language the sum of |p - q|
    over all kept terms, 0 if there are none.  Part `term`: the `first` terms of a source by p - q, q
    of the whole language, where that is above 0.  Ties rank by item.  Every group that occurs has its
    pairs, also without terms; a language with one source has none.  Repeated rows count again; an
    empty table gives no row; other columns are not read.
    """
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    tokens = plain.withColumn("text", F.col("text").cast("binary"))
    frequent = tokens.select("lang", "text").mapInArrow(_frequencies, from_arrow_schema(_FREQUENCIES))
    kept = written(frequent.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_docs).drop("n"), "kept")
    shards = term_slots(kept, shard_terms)
    counts = recount(tokens, shards, bundle_bytes)

    terms = shards.filter("term IS NOT NULL").select("lang", "slot", "term")
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # A row per source of a language, numbered.
    groups = plain.select("lang", "source").distinct().withColumn("sid", F.row_number().over(Window.partitionBy("lang").orderBy("source")))
    groups = written(
        groups.join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left").na.fill(0, ["total", "v"]), "groups"
    )
    shared = counts.join(groups, ["lang", "source"]).select("lang", "source", "sid", "slot", "n", F.expr(_share("n", "total", "v")).alias("p"))
    shared = written(shared, "shares")

    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("v").alias("v"))
    across = counts.groupBy("lang", "slot").agg(F.sum("n").alias("n")).join(whole, "lang")
    across = across.select("lang", "slot", F.expr(_share("n", "total", "v")).alias("q")).join(terms, ["lang", "slot"])
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    by_term = (
        shared.join(across, ["lang", "slot"])
        .filter("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= first)
    )

    most = groups.agg(F.max("sid")).first()[0] or 1
    size = max(min(CELLS // most, BLOCK_TERMS), 1)
    block = F.pmod(F.xxhash64("slot"), F.ceil(F.col("v") / size))
    absent = groups.filter("v > 0").select("lang", "sid", F.explode(F.sequence(F.lit(0), F.ceil(F.col("v") / size) - 1)).alias("block"), F.lit(-1).cast("bigint").alias("slot"), F.expr(_share("0", "total", "v")).alias("p"))
    cells = shared.join(vocabulary, "lang").select("lang", "sid", block.alias("block"), "slot", "p").unionByName(absent)
    parts = cells.groupBy("lang", "block").applyInPandas(lambda key, frame: _distances(frame), "lang string, a bigint, b bigint, value bigint")
    apart = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    # Every pair of sources of a language is asked for, so this join makes the result's own rows.
    names = groups.select("lang", "sid", "source")
    both = names.join(names.select("lang", F.col("sid").alias("other"), F.col("source").alias("item")), "lang").filter("sid <> other")
    both = both.select("lang", "source", "item", F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b"))
    by_pair = (
        both.join(apart, ["lang", "a", "b"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
        .withColumn("rank", F.row_number().over(order))
    )
    return by_pair.unionByName(by_term)
