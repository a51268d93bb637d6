"""Classifier chains for toxicity: each category's model sees the probabilities of the categories before it.

For training, the earlier probabilities are out-of-fold: a row's come from a
model that has not seen the row, so a later model learns how far an earlier one
can be trusted.  For scoring, models fitted on all training rows take their
place.  The linear models are logistic regressions over words and the beginnings
of words: how many distinct words of a text begin so tells more than any one of
them, for insults are inflected and compounded.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerline.llm.common import map_batches, written

WORD = re.compile(r"[^\W_]+")


#: Lengths of the beginnings, and words whose features a worker remembers.
BEGINNINGS = range(3, 9)
REMEMBERED = 300_000


def features_of(word: str) -> list[str]:
    """The word itself, and its beginnings with a mark that no word has."""
    return [word, *(f"^{word[:k]}" for k in BEGINNINGS if k <= len(word))]


def counted(text: str) -> Counter:
    """For each feature, how many distinct words of the text have it."""
    out: Counter = Counter()
    for word in set(WORD.findall(text.lower())):
        out.update(features_of(word))
    return out


def weight_of(count: int) -> float:
    return math.log2(1 + count)


@dataclass(frozen=True)
class Chain:
    """A fitted chain: the place of each feature, and for each category its intercept and weights.

    The weights of category k are those of the features and then of the k
    probabilities before it.
    """

    categories: tuple[str, ...]
    features: dict[str, int]
    intercepts: tuple[float, ...]
    weights: tuple[tuple[float, ...], ...]

    def probabilities(self, text: str, known: dict[str, tuple[int, ...]]) -> list[float]:
        """`known` remembers the places of a word's features between texts."""
        seen: Counter = Counter()
        for word in set(WORD.findall(text.lower())):
            here = known.get(word)
            if here is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                places = self.features
                here = known[word] = tuple(places[f] for f in features_of(word) if f in places)
            if here:
                seen.update(here)
        values = [(k, weight_of(n)) for k, n in seen.items()]
        out: list[float] = []
        for intercept, weights in zip(self.intercepts, self.weights):
            z = intercept + sum(weights[k] * v for k, v in values)
            z += sum(p * w for p, w in zip(out, weights[len(self.features) :]))
            out.append(1 / (1 + math.exp(-max(-500.0, min(500.0, z)))))
        return out


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    rows: int = 8_000,
    vocabulary: int = 2_048,
    least_rows: int = 3,
    folds: int = 3,
    penalty: float = 5e-4,
) -> Chain:
    """Fit on at most `rows` labelled documents, those whose id hashes lowest.

    The sample bounds what is joined by broadcast and what is fitted; nothing
    else is sampled.  Labels are 0 or 1; a row with a NULL among them, or whose
    document has no text, is left out, and of repeated labels the largest counts.
    The `vocabulary` features that tell most about any category are kept, by
    mutual information, among those in `least_rows` sampled documents.  A
    category whose sample has one label only gets that label's smoothed share as
    a constant probability; so does each without any labelled row (share 0).
    """
    categories = tuple(categories)
    known = F.lit(True)
    for c in categories:
        known = known & F.col(c).isNotNull()
    # Labels are drawn before they meet the texts, so this side of the join has `rows` rows at most.
    drawn = (
        labels.filter(known & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(*[F.max(c).cast("int").alias(c) for c in categories])
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL")
    own = [(c, pa.int32()) for c in categories]
    schema = pa.schema(
        [("doc_id", pa.int64()), *own, ("features", pa.list_(pa.string())), ("counts", pa.list_(pa.int32()))]
    )

    def extract(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [counted(t.as_py()) for t in batch.column(batch.schema.get_field_index("text"))]
        kept = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", *categories)]
        lists = [pa.array([list(x) for x in column], kind) for column, kind in (
            ((c.keys() for c in found), pa.list_(pa.string())), ((c.values() for c in found), pa.list_(pa.int32()))
        )]
        yield pa.record_batch([*kept, *lists], schema=schema)

    labelled = map_batches(texts.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", *categories), extract, schema)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(folds)).alias("fold")
    sample = written(labelled.select("doc_id", *categories, fold, "features", "counts"), "labelled")
    shares = sample.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories]).first()
    n, positive = shares["n"], {c: shares[c] or 0 for c in categories}

    def informative(c: str):
        """Mutual information of a word and a category, from the counts of a word's rows."""
        p, total = float(positive[c]), float(n)
        cells = [
            (F.col(c), F.col("n"), p),
            (F.col("n") - F.col(c), F.col("n"), total - p),
            (F.lit(p) - F.col(c), F.lit(total) - F.col("n"), p),
            (F.lit(total - p) - F.col("n") + F.col(c), F.lit(total) - F.col("n"), total - p),
        ]
        parts = [F.when(x > 0, x * F.log(x * total / (y * z))).otherwise(0.0) for x, y, z in cells if z > 0]
        return sum(parts, F.lit(0.0))

    found = (
        sample.select(*categories, F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories])
        .filter(F.col("n") >= least_rows)
        .withColumn("told", F.greatest(*[informative(c) for c in categories], F.lit(0.0)))
        .orderBy(F.desc("told"), "feature")
        .limit(vocabulary)
        .collect()
    )
    place = {row["feature"]: k for k, row in enumerate(sorted(found, key=lambda r: r["feature"]))}
    width = len(place) + len(categories)

    @F.udf(VectorUDT())
    def vector(features, counts, earlier):
        here = {place[f]: weight_of(n) for f, n in zip(features, counts) if f in place}
        return SparseVector(width, {**here, **{len(place) + k: float(p) for k, p in enumerate(earlier)}})

    intercepts, weights = [], []
    # A few thousand narrow rows: a handful of tasks, so that a step of the solver is short.
    train = sample.coalesce(4).withColumn("earlier", F.array().cast("array<double>")).persist()
    for c in categories:
        share = (positive[c] + 1) / (n + 2) if n else 0.0
        if not 0 < positive[c] < n:
            intercepts.append(math.log(share / (1 - share)) if share else -500.0)
            weights.append((0.0,) * width)
            train = train.withColumn("earlier", F.concat("earlier", F.array(F.lit(share))))
            continue
        data = train.withColumn("vector", vector("features", "counts", "earlier")).persist()
        solver = LogisticRegression(labelCol=c, featuresCol="vector", regParam=penalty, maxIter=25, standardization=False, aggregationDepth=2)
        model = solver.fit(data)
        intercepts.append(float(model.intercept))
        weights.append(tuple(float(w) for w in model.coefficients.toArray()))
        if c != categories[-1]:
            parts = []
            for fold in range(folds):
                held = data.filter(F.col("fold") == fold)
                if data.filter(F.col("fold") != fold).select(c).distinct().count() == 2:
                    scored = solver.fit(data.filter(F.col("fold") != fold)).transform(held)
                    p = vector_to_array("probability")[1]
                else:
                    scored, p = held, F.lit(share)
                parts.append(scored.withColumn("earlier", F.concat("earlier", F.array(p))).select(*train.columns))
            joined = parts[0]
            for part in parts[1:]:
                joined = joined.unionByName(part)
            train.unpersist()
            train = written(joined, "out-of-fold").coalesce(4).persist()
        data.unpersist()
    train.unpersist()
    return Chain(categories, place, tuple(intercepts), tuple(weights))


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """All columns of `docs` with `p_<category>` for each category, over whole texts; a NULL text is empty.

    Columns of `docs` with these names give way.  One narrow scan; the model that
    every task gets is bounded by the vocabulary.
    """
    names = [f"p_{c}" for c in chain.categories]
    docs = docs.drop(*names)
    schema = pa.schema([*to_arrow_schema(docs.schema), *((n, pa.float64()) for n in names)])
    # Of a task, for it gets a copy of its own.
    known: dict[str, tuple[int, ...]] = {}

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at = batch.schema.get_field_index("text")
        scores = list(zip(*(chain.probabilities(t.as_py() or "", known) for t in batch.column(at)))) or [()] * len(names)
        yield pa.record_batch([*batch.columns, *(pa.array(s, pa.float64()) for s in scores)], names=schema.names)

    return map_batches(docs, work, schema)
