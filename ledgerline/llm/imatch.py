"""I-Match fingerprints: hashes of the terms of middling rarity, under several random lexicons.

A term is in the lexicon if its inverse document frequency lies in a band: terms
of a large share of the documents tell nothing, and terms of one document alone
would make every text a stranger to its copies.  Each part of a fingerprint takes
the terms of one random subset of the lexicon, sorts the distinct ones and hashes
them.  There are `PARTS` subsets at each level, of every 2**level-th of their
terms.  A text uses the two levels that leave it few terms in a part, so that a
part outlives changes elsewhere in the text, whatever its length.

Everything is DataFrame functions.  Only the terms that some subset keeps are
shuffled, one or two dozen per text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import written

#: Subsets at each level, and the least terms that a part of the lower level has on average.
PARTS, LEAST_TERMS = 8, 1.5


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct words of letters and digits, in lower case."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def level_of(n: Column) -> Column:
    """2**level is the number of terms over `PARTS` * `LEAST_TERMS`, rounded down to a power of two."""
    return F.greatest(F.floor(F.log2(F.greatest(n, F.lit(1)) / (PARTS * LEAST_TERMS))), F.lit(0)).cast("int")


def lexicon(docs: DataFrame, common: float, least: int) -> tuple[DataFrame, DataFrame]:
    """Terms of the band, in `least` documents or more, and the terms above it.

    The second list is short at any size of the corpus: terms that each are in a
    share `common` of all documents number at most a document's mean number of
    terms divided by `common`.
    """
    edge = F.lit(max(common * docs.count(), float(least)))
    counted = docs.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    found = written(counted.filter(F.col("df") >= least), "lexicon")
    return found.filter(F.col("df") <= edge).select("term"), found.filter(F.col("df") > edge).select("term")


#: Added to the level of a text without terms in the band, so that it is compared with its like alone.
OUTSIDE = 1_000


def _fingerprint(level: str, held: str, drawn: str, whole: str) -> Column:
    """The parts of the level and of the next one.

    A text without terms in the band has parts of the terms that were drawn from it, at levels of
    their own, so that its edited form is still like it; without any, `x` and the hash of all terms.
    """

    def made(terms: str, place: Column) -> Column:
        def row(up: int) -> Column:
            parts = []
            for part in range(PARTS):
                mine = F.expr(
                    f"filter({terms}, h -> pmod(h, {PARTS}) = {part} AND shiftright(h, 8) & (shiftleft(1L, {level} + {up}) - 1) = 0)"
                )
                parts.append(F.when(F.size(mine) > 0, F.lower(F.hex(F.xxhash64(mine)))).otherwise(""))
            return F.concat_ws(",", *parts)

        return F.concat_ws("/", place.cast("string"), row(0), row(1))

    nothing = F.concat(F.lit("x"), F.lower(F.hex(F.col(whole))))
    outside = F.when(F.size(drawn) > 0, made(f"sort_array({drawn})", F.col(level) + OUTSIDE)).otherwise(nothing)
    return F.when(F.size(held) > 0, made(held, F.col(level))).otherwise(outside)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal parts among those that either text has, at the common level where it is largest; 1 if all is equal."""

    def parts(fingerprint: Column, row: int) -> Column:
        return F.split(F.get(F.split(fingerprint, "/"), F.lit(1 + row)), ",")

    def level(fingerprint: Column) -> Column:
        return F.get(F.split(fingerprint, "/"), F.lit(0)).try_cast("int")

    def share(i: int, j: int) -> Column:
        both = F.arrays_zip(parts(a, i).alias("a"), parts(b, j).alias("b"))
        either = F.size(F.filter(both, lambda p: (p["a"] != "") | (p["b"] != "")))
        same = F.size(F.filter(both, lambda p: (p["a"] != "") & (p["a"] == p["b"])))
        return F.when((level(a) + i == level(b) + j) & (either > 0), same / either).otherwise(0.0)

    most = F.greatest(*[share(i, j) for i in (0, 1) for j in (0, 1)])
    return F.when(a == b, 1.0).otherwise(F.coalesce(most, F.lit(0.0)))


def followers(docs: DataFrame, partitions: int) -> DataFrame:
    """(doc_id, next_id): for each distinct id the next larger one; the last one's is the first.

    Ids alone are ordered, by range; one row per range meets in the window that
    ties the ranges together.
    """
    ids = docs.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    ranged = written(ids.repartitionByRange(partitions, "doc_id").withColumn("range", F.spark_partition_id()), "ids")
    firsts = ranged.groupBy("range").agg(F.min("doc_id").alias("first"))
    order = Window.orderBy("range")
    over_all = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = firsts.select("range", F.coalesce(F.lead("first").over(order), F.min("first").over(over_all)).alias("after"))
    inner = F.lead("doc_id").over(Window.partitionBy("range").orderBy("doc_id"))
    linked = ranged.withColumn("inner", inner).join(F.broadcast(ends), "range")
    return linked.select("doc_id", F.coalesce("inner", "after").alias("next_id"))


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, text, edited: in `edited` the last quarter gives way to the beginning of the next text.

    floor(n / 4) code points go, and as many come from the text of the next
    larger doc_id (after the last: the first), or all of it if it is shorter.  A
    NULL text is empty.  Rows without an id are left out; of rows that repeat an
    id there is one, with the smallest text.

    Texts are shuffled once, by id; what a text lends to the one before it is
    known by length before it moves on.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = (
        docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    )
    lengths = docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(F.length("text")).alias("length"))
    asked = lengths.join(followers(docs, partitions), "doc_id").select(
        F.col("doc_id").alias("by"),
        F.col("next_id").alias("doc_id"),
        F.floor(F.coalesce("length", F.lit(0)) / 4).cast("int").alias("most"),
    )
    lent = known.join(asked, "doc_id").select(
        F.col("by").alias("doc_id"), F.col("doc_id").alias("next_id"), F.expr("left(text, most)").alias("lent")
    )
    quarter = "int(floor(length(text) / 4))"
    return known.join(lent, "doc_id").select(
        "doc_id",
        "next_id",
        "text",
        F.expr(f"concat(left(text, length(text) - {quarter}), left(lent, {quarter}))").alias("edited"),
    )


def fingerprint_edits(docs: DataFrame, common: float = 0.02, least: int = 2) -> DataFrame:
    """Fingerprints of the texts of `edited` and of their edited forms, and how alike they are.

    One row per doc_id: n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (the next document's).  The lexicon is the terms
    in `least` documents or more, but not in a share above `common` of them.
    """
    band, stop = lexicon(docs.select("text"), common, least)
    sides = {"": "text", "edited_": "edited"}
    rows = edited(docs).select("doc_id", "next_id", "text", "edited")
    for side, column in sides.items():
        rows = rows.withColumn(f"{side}hashes", term_hashes(F.col(column)))
    for side in sides:
        rows = rows.withColumn(f"{side}level", level_of(F.size(f"{side}hashes")))
    keep = "filter({0}hashes, h -> shiftright(h, 8) & (shiftleft(1L, {0}level) - 1) = 0)"
    rows = written(
        rows.select(
            "doc_id",
            "next_id",
            F.length("text").cast("bigint").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            *[F.col(f"{side}level") for side in sides],
            *[F.xxhash64(F.sort_array(f"{side}hashes")).alias(f"{side}whole") for side in sides],
            *[F.expr(keep.format(side)).alias(f"{side}drawn") for side in sides],
        ),
        "drawn-terms",
    )
    wanted = rows.select("doc_id", F.explode(F.array_union("drawn", "edited_drawn")).alias("term"))
    inside = wanted.join(F.broadcast(stop), "term", "left_anti").join(band, "term")
    gathered = inside.groupBy("doc_id").agg(F.sort_array(F.collect_list("term")).alias("inside"))
    held = rows.join(gathered, "doc_id", "left")
    empty = F.array().cast("array<bigint>")
    for side in sides:
        held = held.withColumn(
            f"{side}held", F.sort_array(F.array_intersect(F.coalesce("inside", empty), f"{side}drawn"))
        )
    made = held.select(
        "doc_id", "next_id", "n_chars", "edited_sha256", *[_fingerprint(f"{s}level", f"{s}held", f"{s}drawn", f"{s}whole").alias(f"{s}fingerprint") for s in sides]
    )
    made = written(made, "fingerprints")
    following = made.select(F.col("doc_id").alias("next_id"), F.col("fingerprint").alias("next_fingerprint"))
    return made.join(following, "next_id").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
