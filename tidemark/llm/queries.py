"""The registered queries of the training-data operators: thin readers of the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (ann, centroids, language, mixing, neardup, packing, pieces, quality, secrets, token_rollup, toxicity,
                          trie, warc)
from tidemark.llm.common import durable, id_crc, read
from tidemark.llm.oracle import ORACLE
from tidemark.session import scratch


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_crc() % 5 == 0
    model = language.train(docs.where(~held_out))
    return language.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents by source, language and version of the tokenizer.

    A first batch inserts every document with an estimate and a second revises the estimates to
    counts. A third withdraws the documents without tokens and a fourth brings them back. Each is delivered
    twice, and batches are folded before the last.
    """
    docs = read(spark, sf_dir, "documents").select("source", "lang", "text", F.ceil(F.coalesce(F.length("text"), F.lit(0)) / 4).alias("before"))
    counts = durable(token_rollup.count_tokens(docs, token_rollup.default_vocabularies()))
    rollup, bare = token_rollup.Rollup(spark, scratch(spark)), counts.where("tokens = 0")
    for _ in range(2):
        rollup.commit("load", token_rollup.inserted(counts.withColumn("tokens", F.col("before"))))
        rollup.commit("count", token_rollup.revised(counts))
        rollup.commit("withdraw", token_rollup.deleted(bare))
    rollup.compact()
    for _ in range(2):
        rollup.commit("restore", token_rollup.inserted(bare))
    return rollup.totals()


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    return packing.pack(read(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from labels of rows that are not held out."""
    docs, held_out = read(spark, sf_dir, "documents"), id_crc() % 4 == 2
    model = toxicity.train(docs, read(spark, sf_dir, "labels").where(~held_out))
    return toxicity.score_texts(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record as the archives give it back."""
    return warc.round_trip(read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts, digest and spans."""
    return secrets.digest(secrets.find_secrets(read(spark, sf_dir, "documents")))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id 20 divides."""
    return ann.search(read(spark, sf_dir, "embeddings"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document."""
    return neardup.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict on every document."""
    return quality.judge_quality(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every vector after ten rounds."""
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    return pieces.round_trip(read(spark, sf_dir, "documents"), pieces.default_model())


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of rebuilt conversations."""
    return trie.prefix_trie(read(spark, sf_dir, "conversations")).drop("key", "parent")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language": op1_language, "op2_token_counts": op2_token_counts, "op3_packing": op3_packing,
    "op4_mixing": op4_mixing, "op5_toxicity": op5_toxicity,
    "op6_warc": op6_warc, "op7_secrets": op7_secrets, "op8_neighbours": op8_neighbours,
    "op9_near_duplicates": op9_near_duplicates, "op10_quality": op10_quality,
    "op11_centroids": op11_centroids, "op12_pieces": op12_pieces, "op13_prefix_trie": op13_prefix_trie,
}

__all__ = ["ORACLE", "QUERIES"]
