"""The training-data pipeline: documents in, token files out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import decontaminate, minhash, mixing, tokenfiles, toxicity
from gristmill.llm.components import small_batches
from gristmill.sources.scratch import fresh_path

TOKENIZER = "word_bpe_49k.json"
NEAR_PERCENT = 80  # of five-word shingles that near copies share, at least; op2 has its own contract of 85


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.7, by a model fitted on the labelled training fold."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(
        toxicity.labelled_texts(docs, labels, "toxic", toxicity.label_fold(labels, 3) != 1)
    )
    return toxicity.drop_toxic(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each component of near-duplicates (0.8 or more)."""
    small_batches(spark)
    return minhash.drop_near_duplicates(docs, percent=NEAR_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate takes it."""
    small_batches(spark)
    return mixing.mix_sources(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, read back: where each document lies, and its crc32."""
    small_batches(spark)
    folder = fresh_path(spark, "tokens")
    manifest = tokenfiles.write_token_files(docs, folder, public_tokenizers.path(TOKENIZER))
    return tokenfiles.read_token_files(spark, folder, manifest)


STAGES = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("tokens", write_tokens),
]

ORACLE_SQL = None  # learned scores, MinHash classes and tokenizer ids have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
