"""Near duplicates, leaks and fingerprints."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from ledgerline.llm import imatch, leaks, neardup
from ledgerline.llm.graph import components
from ledgerline.llm.shingles import word_hashes


def brute(pairs, words, percent):
    """Components by comparing every pair."""
    sets = {}
    for i, text in pairs:
        w = (text or "").encode().lower().split()
        whole = {tuple(w)} if w else set()
        sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else whole
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(s), root(i)) for i, s in sets.items()}


def corpus(seed, groups=12, n=120, vocabulary=400):
    """Texts with variants of variants, so that many links lie near the threshold."""
    draw = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(vocabulary)]
    out, at = [], 0
    for _ in range(groups):
        text = [draw.choice(vocabulary) for _ in range(n)]
        for _ in range(draw.randint(1, 9)):
            if draw.random() < 0.8:
                text = list(text)
                for _ in range(draw.randint(0, 4)):
                    text[draw.randrange(len(text))] = draw.choice(vocabulary)
            out.append((at, " ".join(text)))
            at += 1
    draw.shuffle(out)
    return out


@pytest.mark.parametrize("words, seed", [(4, 1), (5, 2)])
def test_near_duplicates_equal_all_pairs(docs, words, seed):
    pairs = corpus(seed) + [(900, "one two"), (901, "ONE  two"), (902, None), (903, "")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs(pairs), words).collect()}
    assert got == brute(pairs, words, 80)
    assert got[901] == (1, 900) and got[902] == (0, 902)


def test_near_duplicates_of_a_large_group(docs):
    """Variants of one text: each is linked to it, few of them to each other."""
    draw = random.Random(5)
    base = [f"b{k}" for k in range(200)]
    pairs = [(0, " ".join(base))]
    for i in range(1, 150):
        text = list(base)
        for k in draw.sample(range(200), 4):
            text[k] = f"x{i}-{k}"
        pairs.append((i, " ".join(text)))
    got = neardup.near_duplicates(docs(pairs), 4).select("doc_id", "component_id").collect()
    want = brute(pairs, 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in want.items()}
    assert {r["component_id"] for r in got} == {0}


def test_near_duplicates_just_too_far_from_a_large_group_are_not_compared_with_all_of_it(docs, monkeypatch):
    """Pairs of variants whose shared edits lie a little too far from the text that all others are near."""
    draw = random.Random(8)
    base = [f"b{k}" for k in range(200)]
    texts = [base]
    for i in range(60):
        text = list(base)
        text[draw.randrange(4, 190)] = f"x{i}"
        texts.append(text)
    for i in range(30):
        places = draw.sample(range(8, 190, 5), 6)
        for twin in range(2):
            text = list(base)
            for k in places:
                text[k] = f"y{i}-{twin if k == places[0] else ''}"
            texts.append(text)
    pairs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    looked_up, real = [], neardup._pairs_left

    def counted(*args):
        looked_up.append(real(*args))
        return looked_up[-1]

    monkeypatch.setattr(neardup, "_pairs_left", counted)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(docs(pairs), 4).collect()}
    assert got == brute(pairs, 4, 80)
    assert len({c for _, c in got.values()}) == 31
    assert sum(df.count() for df in looked_up) <= 5 * len(pairs)


def test_near_duplicates_of_odd_rows(odd, clashing):
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == 10
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["component_id"] == 1 and by_id[1]["n_shingles"] == 0 and by_id[1]["kept"]
    assert {by_id[i]["component_id"] for i in (4, 5, 6)} == {4} and not by_id[5]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert neardup.near_duplicates(clashing).count() == 10
    assert neardup.near_duplicates(odd.limit(0)).count() == 0


def test_estimate_is_close(spark):
    draw = np.random.default_rng(0)
    both = draw.integers(0, 1 << 63, 800, dtype=np.uint64)
    a, b = (np.unique(np.concatenate([both, draw.integers(0, 1 << 63, 100, dtype=np.uint64)])) for _ in range(2))
    sigs = [[int(x) for x in neardup.packed(neardup.minima(s)).view(np.int64)] for s in (a, b)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame([tuple(sigs)], "a array<bigint>, b array<bigint>")
    assert abs(df.select(neardup.estimate(F.col("a"), F.col("b"))).first()[0] - 0.8) < 0.15
    assert df.select(neardup.estimate(F.col("a"), F.col("a"))).first()[0] == 1.0


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 120)] + [(50, 50)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in range(31)}, **{k: 100 for k in range(100, 120)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def smith_waterman(item, passage):
    best, above = 0, [0] * (len(passage) + 1)
    for x in item:
        here = [0]
        for k, y in enumerate(passage):
            step = leaks.MATCH if x == y else leaks.MISMATCH
            here.append(max(0, above[k] + step, above[k + 1] + leaks.GAP, here[k] + leaks.GAP))
        best, above = max(best, max(here)), here
    return best


def test_alignment_equals_the_plain_recurrence():
    draw = np.random.default_rng(1)
    for _ in range(60):
        item, passage = draw.integers(0, 4, draw.integers(1, 20)), draw.integers(0, 4, draw.integers(1, 40))
        value, a, b = leaks.align(item, passage)
        assert value == smith_waterman(item.tolist(), passage.tolist())
        assert 0 <= a <= b <= len(passage)
        assert smith_waterman(item.tolist(), passage[a:b].tolist()) == value


def test_leaks_find_whole_and_edited_copies(spark, docs):
    draw = random.Random(2)
    words = [f"v{k}" for k in range(300)]
    text = lambda n: [draw.choice(words) for _ in range(n)]
    item, other = text(40), text(30)
    edited = [w if k % 7 else "new" for k, w in enumerate(item)]
    pairs = [
        (1, " ".join(text(100) + item + text(50))),
        (2, " ".join(text(60) + edited + text(60))),
        (3, " ".join(text(300))),
        (4, " ".join(item)),
        (5, " ".join(item[:10] + text(200))),
        (6, "Short one"),
        (7, None),
    ]
    bench = spark.createDataFrame([(10, " ".join(item)), (11, " ".join(other)), (12, "short ONE"), (13, None), (None, "x")], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in leaks.leaks(docs(pairs), bench).collect()}
    assert set(got) == {(1, 10), (2, 10), (4, 10), (6, 12)}
    assert got[1, 10]["score"] == 1.0 and (got[1, 10]["start_word"], got[1, 10]["end_word"]) == (100, 140)
    assert 0.5 < got[2, 10]["score"] < 1.0


def test_leaks_that_every_document_has_are_found(spark, docs):
    item = " ".join(f"v{k}" for k in range(20))
    pairs = [(i, f"a{i} b{i} {item} c{i}") for i in range(50)]
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    assert leaks.leaks(docs(pairs), bench).count() == 50


def test_leaks_common_edited_copy_is_found(spark, docs):
    words = [f"v{k}" for k in range(40)]
    edited = " ".join("new" if k in (10, 20) else w for k, w in enumerate(words))
    pairs = [(i, f"a{i} b{i} {edited} c{i}") for i in range(50)] + [(50, " ".join(words)), (51, "nothing of it")]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    got = {r["doc_id"]: r["score"] for r in leaks.leaks(docs(pairs), bench).collect()}
    assert set(got) == set(range(51)) and got[50] == 1.0


def test_leaks_equal_alignment_of_every_pair(spark, docs):
    draw = random.Random(5)
    common = [f"c{k}" for k in range(12)]
    items = [[draw.choice(common + [f"i{j}x{k}" for k in range(9)]) for _ in range(draw.randint(4, 24))] for j in range(12)]
    pairs = []
    for i in range(150):
        body = list(draw.choice(items))
        if i % 5 == 0:
            body = [x for w in body for x in (w, f"p{i}")]
        elif i % 5 == 1:
            body = [w if k % 4 != 3 else f"p{i}" for k, w in enumerate(body)]
        elif i % 5 == 2:
            body = [w if k % 3 != 2 else f"p{i}" for k, w in enumerate(body)]
        else:
            rate = draw.random() / 2
            body = [w for w in body if draw.random() > rate]
        pairs.append((i, " ".join([draw.choice(common) for _ in range(20)] + body + [draw.choice(common) for _ in range(20)])))
    bench = spark.createDataFrame([(j, " ".join(item)) for j, item in enumerate(items)], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in leaks.leaks(docs(pairs), bench).collect()}
    want = {}
    for i, text in pairs:
        for j, item in enumerate(items):
            score = smith_waterman(item, text.split()) / (leaks.MATCH * len(item))
            if score >= 0.5:
                want[i, j] = score
    assert got == want


def test_leak_seeds_are_the_rarest_pairs_of_all_documents(spark, docs, monkeypatch):
    tables, write = {}, leaks.written
    monkeypatch.setattr(leaks, "written", lambda frame, label: tables.setdefault(label, write(frame, label)))
    words = [f"v{k}" for k in range(20)]
    # The pair of words k and k + 1 is in the documents 0 to k.
    pairs = [(i, " ".join(f"v{k} v{k + 1} x{i}y{k} z{i}y{k}" for k in range(i, 19))) for i in range(19)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    leaks.leaks(docs(pairs), bench).count()
    hashes = word_hashes([w.encode() for w in words])
    rarest = leaks.pair_hashes(hashes[:-1], hashes[1:])[: 19 - leaks.least_pairs(20, 0.5) + 1]
    assert {r["gram"] for r in tables["seeds"].collect()} == set(rarest.view(np.int64).tolist())


def test_leaks_of_odd_rows(spark, odd, clashing):
    bench = spark.createDataFrame([(1, "same words here and there again"), (1, "same words here and there again")], "item_id bigint, text string")
    for frame in (odd, clashing):
        assert sorted(r["doc_id"] for r in leaks.leaks(frame, bench).collect()) == [4, 5, 6]
    assert leaks.leaks(odd.limit(0), bench).count() == 0
    assert leaks.leaks(odd, bench.limit(0)).count() == 0


@pytest.mark.parametrize("vocabulary", [400, 20_000])
def test_fingerprints(docs, vocabulary):
    """With words that are all above the band, and with rare ones.  Variants of one text are no strangers."""
    pairs = [(2 * i, t) for i, t in corpus(4, groups=40, vocabulary=vocabulary)]
    rows = {r["doc_id"]: r for r in imatch.fingerprint_edits(docs(pairs)).collect()}
    text, ids = dict(pairs), sorted(i for i, _ in pairs)
    near, far, prints = [], [], defaultdict(set)
    for at, i in enumerate(ids):
        after = text[ids[(at + 1) % len(ids)]]
        cut = len(text[i]) // 4
        edited = text[i][: len(text[i]) - cut] + after[:cut]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        prints[text[i]].add(rows[i]["fingerprint"])
        near.append(rows[i]["near_edited"])
        one, other = set(text[i].split()), set(after.split())
        if len(one & other) < 0.6 * min(len(one), len(other)):
            far.append(rows[i]["near_next"])
        elif text[i] == after:
            assert rows[i]["near_next"] == 1.0
    assert all(len(p) == 1 for p in prints.values())
    assert len(far) > 20 and np.mean(near) > np.mean(far) + 0.2
    assert all(0 <= x <= 1 for x in (*near, *far))


def test_fingerprints_of_odd_rows(odd, clashing):
    for frame in (odd, clashing):
        rows = {r["doc_id"]: r for r in imatch.fingerprint_edits(frame).collect()}
        assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7, 8]
        assert rows[4]["fingerprint"] == rows[5]["fingerprint"] and rows[4]["near_next"] == 1.0
        assert rows[1]["fingerprint"] == rows[2]["fingerprint"] and rows[1]["n_chars"] == 0
    assert imatch.fingerprint_edits(odd.limit(0)).count() == 0
    one = imatch.fingerprint_edits(odd.filter("doc_id = 4")).first()
    assert one["near_next"] == 1.0
