"""From documents to token ids: toxic texts, near copies and benchmark passages go, secrets are blanked, the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes it as
Parquet and gives what it reads back to the next.  All stages but the last
return the columns of `documents`, whatever they are called.  Every stage judges
rows, not ids, so of rows that share an id each has its own fate.  NULL and empty
texts are clean and like nothing, and pass.  An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import chunks, grammar, leaks, neardup, toxicity
from ledgerline.llm.common import read_table, written

#: SQL cannot express a trained classifier or a tokenizer; the tests hold each stage against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    """Documents whose probability of being toxic, at the end of the chain, is below the threshold."""
    chain = toxicity.fit_chain(docs, read_table(spark, sf_dir, "labels"), ("quality", "toxic"))
    return toxicity.score(docs, chain).filter(F.col("p_toxic") < threshold).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id, and of rows that repeat it one.

    A row without words is like nothing, and one without an id is left alone.
    """
    rows, number = _numbered(docs)
    found = written(neardup.near_duplicates(rows, words=5, similarity=0.8, row=number), "near-copies")
    grouped = found.filter("component IS NOT NULL")
    first = grouped.groupBy("component").agg(F.min(F.struct("doc_id", number)).alias("first"))
    more = grouped.join(first, "component").filter(F.col("first") != F.struct("doc_id", number))
    return _without(rows, more, number)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark."""
    rows, number = _numbered(docs)
    found = leaks.leaks(rows.select(F.col(number).alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    return _without(rows, found.select(F.col("doc_id").alias(number)).distinct(), number)


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, a mark in the place of each secret."""
    return grammar.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, with their number and digests."""
    return chunks.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a number of each row, and the name of its column, which no other has.

    The number is a hash of the file and the place of the row in it, so it is the
    same in every scan, whatever ids repeat or are missing.  A frame that is no
    file scan is written first.
    """
    name = "row_" + "_".join(docs.columns)
    number = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(name)
    try:
        return docs.select(*docs.columns, number), name
    except AnalysisException:
        docs = written(docs, "numbered")
        return docs.select(*docs.columns, number), name


def _without(rows: DataFrame, bad: DataFrame, number: str) -> DataFrame:
    """The rows whose number is not among the `bad` ones.  Both sides of the join are tables, read as they are."""
    return rows.join(written(bad.select(number), "dropped"), number, "left_anti").drop(number)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", blank_secrets),
    ("bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each one's rows written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
