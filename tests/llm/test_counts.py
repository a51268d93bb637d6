"""Grace deduplication, the divergence audit and hard negatives against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.llm import divergence, grace, negatives
from ledgerline.llm.perfect_hash import PerfectHash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Grace deduplication ---------------------------------------------------------


def lowered(text):
    return (text or "").translate(UPPER)


def copies(pairs):
    """For each row (doc_id, keep_id, group_size, kept, sha256), sorted; of repeated rows the first stays."""
    groups = defaultdict(list)
    for at, (i, text) in enumerate(pairs):
        groups[lowered(text)].append((i if i is not None else -math.inf, -at))
    out = []
    for at, (i, text) in enumerate(pairs):
        group = groups[lowered(text)]
        top = max(group)
        keep = None if top[0] == -math.inf else top[0]
        out.append((i, keep, len(group), -at == top[1], hashlib.sha256(lowered(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def found_copies(frame, **sizes):
    found = grace.exact_duplicates(frame, **sizes)
    return sorted((tuple(r) for r in found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_table_compares_contents():
    table = grace.ContentTable(1 << 20)
    contents = [b"%d" % (k % 150) for k in range(600)]
    # One hash for all: only the contents tell them apart.
    entries = [table.place(7, c) for c in contents]
    assert entries == [k % 150 for k in range(600)]


def test_full_table_refuses_all_that_is_new():
    table = grace.ContentTable(2 * grace.ENTRY_BYTES + 20)
    assert table.place(1, b"x" * 5_000) == 0  # the first is taken at any size
    assert table.place(2, b"second") == -1 and table.place(3, b"") == -1
    assert table.place(1, b"x" * 5_000) == 0


@pytest.mark.parametrize(
    "sizes",
    [
        {},
        {"absorb_bytes": 900},
        {"absorb_bytes": 900, "bucket_bytes": 1_500},
        {"absorb_bytes": 500, "bucket_bytes": 1_500, "hot_records": 3},
    ],
)
def test_copies_equal_brute_force(docs, sizes):
    draw = random.Random(5)
    pool = ["", "a", "A", "ä", "Ä", *("text %d " % k * draw.randint(1, 40) for k in range(60))]
    pairs = [(k, draw.choice(pool)) for k in range(400)] + [(1_000 + k, "Hot Text") for k in range(300)]
    draw.shuffle(pairs)
    assert found_copies(docs(pairs).repartition(6), **sizes) == copies(pairs)


def test_copies_of_odd_rows(odd, clashing):
    pairs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for frame in (odd, clashing):
        got = found_copies(frame.coalesce(1))
        assert got == copies(pairs)
        assert sum(r[3] for r in got) == len({lowered(t) for _, t in pairs})
    assert found_copies(odd.limit(0)) == []


def test_rows_that_repeat_id_and_text_leave_one(docs):
    pairs = [(4, "same")] * 3 + [(None, "SAME"), (None, "none"), (None, "none")]
    got = found_copies(docs(pairs).repartition(3))
    assert [r[:4] for r in got if r[0] == 4] == [(4, 4, 4, False), (4, 4, 4, False), (4, 4, 4, True)]
    assert sorted(r[3] for r in got if r[1] is None) == [False, True]


def test_documents_without_copies(clashing):
    left = grace.without_copies(clashing)
    assert left.columns == clashing.columns
    rows = left.collect()
    assert sorted(lowered(r["text"]) for r in rows) == sorted({lowered(r["text"]) for r in clashing.collect()})
    assert {r["doc_id"] for r in rows if r["text"] == "same words here and there again"} == {6}


def test_spilled_contents_take_more_levels(docs, monkeypatch):
    levels = []
    keep = grace.written

    def seen(frame, label):
        levels.append(label)
        return keep(frame, label)

    monkeypatch.setattr(grace, "written", seen)
    pairs = [(k, "%d " % k * 50) for k in range(200)]
    # Room for two contents: a bucket with more of them spills what comes after.
    found = grace.exact_duplicates(docs(pairs), bucket_bytes=800)
    assert found.filter("kept AND group_size = 1").count() == 200
    assert len([x for x in levels if x.startswith("grace-")]) > 1


# Perfect hashes --------------------------------------------------------------


@given(st.sets(st.binary(max_size=12), max_size=300), st.sets(st.binary(max_size=12), max_size=50))
def test_perfect_hash(keys, others):
    keys = sorted(keys)
    made = PerfectHash(keys, divergence.term_hashes(keys))
    read = PerfectHash.unpacked(made.packed())
    slots = read.slots(keys, divergence.term_hashes(keys))
    assert sorted(slots.tolist()) == list(range(len(keys))) and len(read) == len(keys)
    assert [read.key(s) for s in slots.tolist()] == keys
    others = sorted(others - set(keys))
    assert set(read.slots(others, divergence.term_hashes(others)).tolist()) <= {-1}


def test_perfect_hash_of_keys_with_one_hash():
    keys, same = [b"a", b"bb", b"ccc"], np.full(3, 99, np.uint64)
    made = PerfectHash(keys, same)
    assert sorted(made.slots(keys, same).tolist()) == [0, 1, 2]
    assert made.slots([b"d"], same[:1]).tolist() == [-1]


# Divergence ------------------------------------------------------------------


def audit(rows, least, first):
    """The audit by plain counting."""
    rows = [(t or "", lang or "", s or "") for t, lang, s in rows]
    split = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(UPPER))
    df, counts = defaultdict(Counter), defaultdict(Counter)
    for t, lang, s in rows:
        df[lang].update(set(split(t)))
    kept = {lang: {w for w, n in c.items() if n >= least} for lang, c in df.items()}
    for t, lang, s in rows:
        counts[lang, s].update(w for w in split(t) if w in kept[lang])
    out = []
    for lang in df:
        v = len(kept[lang])
        groups = {s for _, other, s in rows if other == lang}
        whole = sum((counts[lang, s] for s in groups), Counter())

        def share(c, w):
            return 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * v)

        for s in groups:
            mine = counts[lang, s]
            pairs = [(o, sum(abs(share(mine, w) - share(counts[lang, o], w)) for w in kept[lang])) for o in groups - {s}]
            terms = [(w, share(mine, w) - share(whole, w)) for w in kept[lang] if mine[w] and share(mine, w) > share(whole, w)]
            for part, found, most in (("pair", pairs, None), ("term", terms, first)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(found[:most], 1)]
    return sorted(out)


SMALL = [{}, {"shard_terms": 5}, {"shard_terms": 5, "bundle_bytes": 1_500}]


@pytest.mark.parametrize("sizes", SMALL)
def test_divergence_equals_counting(spark, sizes, monkeypatch):
    monkeypatch.setattr(divergence, "CELLS", 60)
    draw = random.Random(8)
    words = ["Straße", "ÀÉ", "x", "don't", "word_a", "𝒳y", *(f"w{chr(97 + k)}{'z' * (k % 4)}" for k in range(26))]
    rows = []
    for k in range(160):
        lang, source = draw.choice(["en", "de", None, "en"]), draw.choice(["a", "b", "c", None, "É"])
        some = words[: 12 if source == "a" else 32]
        rows.append((" ".join(draw.choice(some).upper() if draw.random() < 0.3 else draw.choice(some) for _ in range(draw.randint(0, 60))), lang, source))
    rows += [(None, "en", "silent"), ("", "xx", "one"), ("only 12 here", "yy", "p"), ("", "yy", "q")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    got = divergence.divergence(frame.repartition(5), least_docs=3, first=7, **sizes).collect()
    want = audit(rows, 3, 7)
    assert sorted(tuple(r) for r in got) == want
    assert ("yy", "p", "pair", "q", 0, 1) in want and not any(r[0] == "xx" for r in want)


def test_divergence_hands_counters_on(spark, monkeypatch):
    monkeypatch.setattr(divergence, "COUNTED_TERMS", 3)
    rows = [(f"one two three {w}", "en", s) for s in "abcd" for w in ("four", "five", "six")]
    frame = spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1)
    kept = divergence.written(spark.createDataFrame([("en", w) for w in ("one", "two", "four", "Ω")], "lang string, term string"), "kept")
    shards = divergence.term_slots(kept, 2)
    plain = frame.withColumn("text", F.col("text").cast("binary"))
    found = divergence.recount(plain, shards, counter_bytes=1).join(shards.filter("term IS NOT NULL"), ["lang", "slot"])
    want = {(s, w, n) for s in "abcd" for w, n in (("one", 3), ("two", 3), ("four", 1))}
    assert {(r["source"], r["term"], r["n"]) for r in found.collect()} == want


def test_divergence_of_odd_rows(odd, clashing, spark):
    want = audit([(r["text"], r["lang"], r["source"]) for r in odd.collect()], 1, 50)
    for frame in (odd, clashing):
        assert sorted(tuple(r) for r in divergence.divergence(frame, least_docs=1).collect()) == want
    assert divergence.divergence(odd.limit(0)).count() == 0
    assert divergence.divergence(odd, least_docs=1_000).count() == 0


def test_shares_are_exact_for_large_counts(spark):
    n, total, v = 9_007_199_254_740_993, 9_100_000_000_000_000_007, 3_000_000_019
    got = spark.range(1).select(F.expr(divergence._share(f"{n}L", f"{total}L", f"{v}L")).alias("p")).first()["p"]
    assert got == 1 + 10**9 * (n + 5) // (total + 5 * v)


# Hard negatives --------------------------------------------------------------

VECTORS = "vec_id bigint, label int, embedding array<float>"


def mined(rows, every, positives, most, low, high):
    """Hard negatives by scoring every pair."""
    fine = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, label, v) in enumerate(fine):
        if i % every:
            continue
        scored = sorted((-sum(map(int.__mul__, v, w)), j, other) for k, (j, other, w) in enumerate(fine) if k != at)
        near = [(-s, j) for s, j, other in scored if other == label][:positives]
        for p, j in near:
            hard = [(-s, k) for s, k, other in scored if other != label and low * p <= -100 * s <= high * p][:most]
            out += [(i, j, rank, k, p, s) for rank, (s, k) in enumerate(hard, 1)]
    return sorted(out)


def vectors(seed, n, size=6, values=None):
    draw = np.random.default_rng(seed)
    table = draw.normal(size=(n, size)) if values is None else draw.choice(values, size=(n, size))
    return [(int(k), int(draw.integers(0, 3)), [float(np.float32(x)) for x in row]) for k, row in enumerate(table)]


@pytest.mark.parametrize("sizes", [{}, {"anchor_block": 3}])
@pytest.mark.parametrize("values", [None, [0.0, 0.5, 1.0]])
def test_negatives_equal_all_pairs(spark, sizes, values, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 40)
    monkeypatch.setattr(negatives, "CELLS", 100)
    rows = vectors(3, 300, values=values) + [(300 + k, 1, [0.5] * 6) for k in range(120)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = negatives.hard_negatives(frame, F.col("vec_id") % 20 == 0, 4, 6, **sizes)
    assert sorted(tuple(r) for r in got.collect()) == mined(rows, 20, 4, 6, 30, 90)


def test_negatives_of_odd_rows(spark):
    rows = vectors(4, 60) + [
        (None, 1, [1.0] * 6),
        (100, None, [1.0] * 6),
        (120, 1, None),
        (140, 1, [1.0, None]),
        (160, 1, [float("nan")] * 6),
        (180, 1, [float("inf")] * 6),
        (200, 1, []),
        (220, 1, [2.0]),
        (0, 1, [1.0] * 6),
        (-20, 2, [1.0] * 9),
    ]
    frame = spark.createDataFrame(rows, VECTORS)
    clash = frame.withColumns({c: F.lit("x") for c in "row vector anchor key is_anchor anchor_id".split()})
    want = mined(rows, 20, 5, 10, 30, 90)
    for df in (frame, clash):
        got = sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 20 == 0).collect())
        assert got == want
    assert {0, 220, -20} <= {r[0] for r in want}
    assert negatives.hard_negatives(frame.limit(0), F.lit(True)).count() == 0
    assert negatives.hard_negatives(frame, F.lit(False)).count() == 0
    assert negatives.hard_negatives(frame.filter("label = 1"), F.col("vec_id") % 20 == 0).count() == 0


def test_products_beyond_doubles_stay_exact():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**40, 1.0], [2.0**10, 1.0], [-(2.0**40), 0.0]])
    assert negatives.inner_products(a, b).tolist() == [[2**63 - 1, 2**50 + 3, -(2**63)]]
    big = np.array([[2.0**31, 1.0]])
    assert negatives.inner_products(big, big).tolist() == [[2**62 + 1]]


def test_large_scores_rank_and_open_windows(spark):
    rows = [(0, 0, [2.0**20]), (1, 0, [2.0**21]), (2, 1, [2.0**20]), (3, 1, [1.5 * 2**20]), (4, 1, [2.0**30])]
    got = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 0, bounds=(30, 90))
    assert sorted(tuple(r) for r in got.collect()) == mined(rows, 10, 5, 10, 30, 90)


def test_keys_sort_like_their_parts():
    draw = np.random.default_rng(1)
    parts = draw.integers(-(2**62), 2**62, size=(200, 3))
    parts[:50, 0], parts[:25, 1] = 5, -7
    keys = negatives.packed_keys(parts[:, 0], parts[:, 1], negatives.NEGATIVE, parts[:, 2])
    back = negatives.unpacked_keys(keys)
    assert (back[:, [0, 1, 3]] == parts).all()
    order = sorted(range(200), key=lambda k: (parts[k, 0], -parts[k, 1], parts[k, 2]))
    assert sorted(range(200), key=lambda k: keys[k].as_py()) == order


def test_windows_stream_by(spark):
    """The iterator alone: keys in order, over batch borders, two anchors."""
    rows = []
    for anchor, scores in ((1, [100, 90, 60]), (2, [50])):
        rows += [(anchor, s, negatives.POSITIVE, 10 + k) for k, s in enumerate(scores)]
        rows += [(anchor, s, negatives.NEGATIVE, 50 + s) for s in range(5, 100, 5)]
    rows.sort(key=lambda r: (r[0], -r[1], r[2], r[3]))
    batches = []
    for start in range(0, len(rows), 7):
        part = np.array(rows[start : start + 7])
        kinds = [negatives.packed_keys(part[k : k + 1, 0], part[k : k + 1, 1], int(part[k, 2]), part[k : k + 1, 3]) for k in range(len(part))]
        ids = pa.array(part[:, 0])
        batches.append(pa.record_batch([ids, ids, pa.concat_arrays(kinds)], names=["anchor", "anchor_id", "key"]))
    out = [tuple(r.values()) for b in negatives._streamed(iter(batches), 2, 3, (30, 90)) for r in b.to_pylist()]
    want = []
    for anchor, near in ((1, [(100, 10), (90, 11)]), (2, [(50, 10)])):
        for p, i in near:
            hard = [s for s in range(95, 0, -5) if 30 * p <= 100 * s <= 90 * p][:3]
            want += [(anchor, i, k, 50 + s, p, s) for k, s in enumerate(hard, 1)]
    assert sorted(out) == sorted(want)
