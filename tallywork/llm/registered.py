"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import (
    arrow_shards,
    binary_packing,
    bloom_sketch,
    golay_simhash,
    language_mixture,
    line_crf,
    oracles,
    orchard,
    page_crf,
    patience_dedup,
    pfair_mixing,
    pii_spans,
    prefix_trie,
    window_entropy,
)
from tallywork.llm.shared import new_folder, table


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and verdict of each document, by a field learned from the labelled documents."""
    documents = table(spark, sf_dir, "documents")
    common = line_crf.common_lines(documents)
    return line_crf.judged(documents, line_crf.fitted(documents, table(spark, sf_dir, "labels"), common), common).drop("content")


def op2_bloom_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's sketch, and its likeness to its edited text and to the next document."""
    return bloom_sketch.compared(table(spark, sf_dir, "documents"))


def op3_arrow_shards(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Place and checksum of each document's ids, read back from the Arrow files."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    shards = arrow_shards.write_shards(table(spark, sf_dir, "documents"), new_folder(spark, "shards-arrow"), path)
    return arrow_shards.read_documents(shards)


def op4_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of each document."""
    found = golay_simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op5_page_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    pages = table(spark, sf_dir, "pages")
    return page_crf.extracted(pages, page_crf.fitted(pages))


def op6_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, and its mixture."""
    documents = table(spark, sf_dir, "documents").withColumn("held_out", language_mixture.held_out(F.col("doc_id")))
    return language_mixture.with_language(documents, language_mixture.learned(documents), ["doc_id", "held_out"])


def op7_binary_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All pieces of all documents."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return binary_packing.packed(table(spark, sf_dir, "documents"), path, keep_ids=False)


def op8_patience_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without the blocks that it shares with an earlier one."""
    return patience_dedup.without_repeats(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_deleted")


def op9_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's place in the mixture of the sources."""
    found = pfair_mixing.scheduled(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), bounded=False)
    return found.select("doc_id", "source", "block", "phase", "release", "deadline", "slot", "mix_place")


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in each document."""
    found = pii_spans.personal_data(table(spark, sf_dir, "documents"))
    counts = [pii_spans.counted(F.col("base_spans"), kind.name).alias(f"n_{kind.name}") for kind in pii_spans.BASE]
    base, every = pii_spans.listed(F.col("base_spans")), F.col("spans")
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), pii_spans.listed(every).alias("spans"), pii_spans.listed(every, score=True).alias("scored"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of spliced conversations."""
    return prefix_trie.trie(prefix_trie.spliced(prefix_trie.turn_lists(table(spark, sf_dir, "conversations"))))


def op12_window_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of secrets in each document."""
    found = window_entropy.secrets(table(spark, sf_dir, "documents"))
    counts = [window_entropy.counted(F.col("base_spans"), kind.name).alias(f"n_{kind.name}") for kind in window_entropy.BASE]
    base, every = window_entropy.listed(F.col("base_spans")), F.col("spans")
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), window_entropy.listed(every).alias("spans"), window_entropy.listed(every, entropy=True).alias("scored"))


def op13_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of each vector, and what the clusters add up to."""
    found = orchard.clustered(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", orchard.digest().alias("centroid_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_crf": op1_line_crf,
    "op2_bloom_sketch": op2_bloom_sketch,
    "op3_arrow_shards": op3_arrow_shards,
    "op4_golay_simhash": op4_golay_simhash,
    "op5_page_crf": op5_page_crf,
    "op6_language_mixture": op6_language_mixture,
    "op7_binary_packing": op7_binary_packing,
    "op8_patience_dedup": op8_patience_dedup,
    "op9_pfair_mixing": op9_pfair_mixing,
    "op10_pii_spans": op10_pii_spans,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_window_entropy": op12_window_entropy,
    "op13_orchard": op13_orchard,
}
ORACLES = oracles.ORACLES
