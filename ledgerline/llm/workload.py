"""The corpus operators as queries over the driver tables, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import brown, chunks, divergence, external, grace, grammar, imatch, leaks, neardup, negatives, records, toxicity, warc
from ledgerline.llm.common import read_table, written
from ledgerline.sources.scratch import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(read_table(spark, sf_dir, "documents"))


@query
def op2_secret_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = grammar.find_secrets(docs)

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, ("assign", "access", "hex")),
        F.sha2(grammar.span_list(F.col("base")), 256).alias("base_sha256"),
        grammar.span_list(F.concat("base", "learned")).alias("spans"),
    )


@query
def op3_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), words=4, similarity=0.8)


@query
def op4_chunked_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunks.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=False)


@query
def op5_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "shards")
    external.external_shuffle(read_table(spark, sf_dir, "documents"), folder, shards=24)
    return external.read_shards(spark, folder).select(
        "doc_id",
        external.record_size(F.col("text")).alias("size"),
        external.text_crc32(F.col("text")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op6_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(read_table(spark, sf_dir, "documents"))


@query
def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "token-records")
    docs = read_table(spark, sf_dir, "documents")
    records.write_records(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    index = records.written_index(spark, folder)
    return records.token_starts(index).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit_chain(docs, read_table(spark, sf_dir, "labels"), ("quality", "toxic"))
    scored = toxicity.score(docs, chain).drop("text")
    return scored.withColumn("toxic", F.col("p_toxic") >= 0.5)


@query
def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op10_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_folder(spark, "warc")
    warc.write_warc(read_table(spark, sf_dir, "pages"), folder)
    captures = warc.assemble(warc.read_warc(spark, folder, keep_blocks=False)).select(
        "capture_id",
        "capture.record_type",
        "capture.payload_bytes",
        "capture.payload_digest",
        F.coalesce("capture.refers_to_id", "capture_id").alias("stored_id"),
        warc.page_id_of(F.col("metadata.block")).alias("page_id"),
    )
    captures = written(captures, "captures")
    # A response is found under its own id, so no key is NULL; a much revisited one is split by adaptive execution.
    stored = captures.filter("record_type = 'response'").groupBy("capture_id").agg(F.min("page_id").alias("stored_page"))
    return captures.join(stored.withColumnRenamed("capture_id", "stored_id"), "stored_id", "left").select(
        "page_id",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.when(F.col("record_type") == "revisit", F.col("stored_page")).alias("refers_to"),
    )


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read_table(spark, sf_dir, "documents"), least_docs=30, first=50)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query
def op13_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = grace.exact_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
