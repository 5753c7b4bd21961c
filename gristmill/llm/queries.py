"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import (
    cross_entropy, decontaminate, hamming_index, line_bloom, minhash, mixing, prefix_trie, quality, secret_scan,
    skyband, substring_dedup, tokenfiles, toxicity,
)
from gristmill.llm.components import marked, small_batches
from gristmill.sources.scratch import fresh_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return hamming_index.nearest(_table(spark, folder, "embeddings"), F.col("id") % 100 == 0)


def op2_minmax_hash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"))


def op3_rule_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    fold = toxicity.label_fold(labels, 5)
    model = quality.fit_quality(toxicity.labelled_texts(docs, labels, "quality", fold != 0))
    scored = quality.score_quality(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.coalesce(toxicity.label_fold(scored, 5) == 0, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.3).cast("int").alias("predicted"),
    )


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    manifest = tokenfiles.write_token_files(_table(spark, folder, "documents"), path, tokenizer)
    return tokenfiles.read_token_files(spark, path, manifest)


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    forest = secret_scan.fit_forest(secret_scan.planted_findings(docs))
    return secret_scan.scan_secrets(docs, forest)


def op6_suffix_automata(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.deduplicate_substrings(_table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.fit_toxicity(
        toxicity.labelled_texts(docs, labels, "toxic", toxicity.label_fold(labels, 3) != 1)
    )
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.coalesce(toxicity.label_fold(scored, 3) == 1, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
    )


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.find_leaks(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    )


def op9_cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    """Target: the documents labelled as of good quality; background: all documents."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    flagged = marked(docs.select("doc_id", "text"), good, "doc_id", "good")
    return cross_entropy.cross_entropy_difference(flagged, F.col("good"))


def op10_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_plan(_table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op11_line_bloom(spark: SparkSession, folder: str) -> DataFrame:
    cut = line_bloom.drop_frequent_lines(_table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select(
        "doc_id", "line_dedup.n_lines", "line_dedup.n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


def op13_skyband(spark: SparkSession, folder: str) -> DataFrame:
    return skyband.divergence(_table(spark, folder, "documents"))


def catalog() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_multi_index_hashing, op2_minmax_hash, op3_rule_quality, op4_token_files, op5_secret_scan,
        op6_suffix_automata, op7_toxicity, op8_decontaminate, op9_cross_entropy, op10_mix_sources,
        op11_line_bloom, op12_prefix_trie, op13_skyband,
    )}
