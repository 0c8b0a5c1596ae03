"""Queries of the corpus operators over the whole tables, and the DuckDB SQL
of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureforge.llm import (alignment, decontaminate, kneserney, licenses, neardup, packing, pages, prefix_trie,
                                  quality, shards, substrings, tokens, toxicity)

SIZE_LIMIT = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the 32k piece model."""
    return tokens.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                               limit=SIZE_LIMIT)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        carry="crc32").select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                              "sequence_id", "offset")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.main_texts(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left after removing 13-word windows that a smaller id also has."""
    return substrings.deduplicate_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that every document holds, and the best covered one."""
    best = F.element_at(F.array_sort("licenses", lambda a, b: F.when(a["coverage"] * a["n_words"] >= b["coverage"] * b["n_words"], -1)
                                     .otherwise(1)), 1)
    scanned = licenses.license_scan(table(spark, sf_dir, "documents"))
    return scanned.select(
        "doc_id", "n_words", F.size("licenses").cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.transform("licenses", lambda x: x["license"])), ",").alias("licenses"),
        F.when(F.size("licenses") > 0, best).alias("best")).select(
        "doc_id", "n_words", "n_licenses", "licenses", F.col("best.license").alias("best_license"),
        F.col("best.coverage").alias("best_coverage"), F.col("best.first").alias("first_word"),
        F.col("best.last").alias("last_word"))


def op6_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def toxic_held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; a fifth of the labels is held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxic_held_out())
    return toxicity.score(docs, model).select("doc_id", toxic_held_out().alias("held_out"), "score", "predicted")


def op8_language_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents; a seventh is held out."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return kneserney.language_scores(table(spark, sf_dir, "documents"), held_out)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base rules and the threshold table's verdict per document."""
    return quality.quality_filter(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.with_verdict(found).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                                                    "contaminated")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    nodes, ends = prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    ending = nodes.where("end_key IS NOT NULL").join(prefix_trie.ends_digests(ends), "end_key").select(*columns)
    return ending.unionByName(nodes.where("end_key IS NULL").withColumn("ends_sha256", F.sha2(F.lit(""), 256)).select(*columns))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes, equal texts together."""
    return shards.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of two tokenizers over all documents."""
    return alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                               public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_token_counts, op2_packing, op3_main_text, op4_substring_dedup, op5_license_scan, op6_minhash_neardup,
    op7_toxicity, op8_language_scores, op9_quality_rules, op10_decontaminate, op11_prefix_trie, op12_sharding,
    op13_alignment)}

ORACLES: dict[str, str] = {
    "op4_substring_dedup": substrings.oracle_sql(),
    "op6_minhash_neardup": neardup.oracle_sql(),
    "op9_quality_rules": quality.oracle_sql(),
    "op10_decontaminate": decontaminate.oracle_sql(),
}
