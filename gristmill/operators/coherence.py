"""TF-IDF cosine between two text columns of each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.text import computed_once
from gristmill.operators.ranks import sample_exact
from gristmill.streaming.guards import require_batch

_BROADCAST_TERMS = 100_000  # a larger vocabulary is left to Spark's own choice of join


def tokens(c: str) -> Column:
    """Lower-cased runs of two or more word characters."""
    text = F.coalesce(F.lower(c), F.lit(""))
    return F.regexp_extract_all(text, F.lit(rf"{fixed.WORD}{{2,}}"), F.lit(0))


def vocabulary(
    df: DataFrame, fit: str, n_rows: Column, max_features: int = fixed.MAX_FEATURES,
    stop_words: Sequence[str] = (),
) -> DataFrame:
    """(term, idf): the most frequent terms of a column, ties broken by the term.

    One pass over that column: each text contributes all its tokens, then each
    distinct one once more, and the position tells the two counts apart.
    """
    texts = computed_once(df.select(fit), {"_t": tokens(fit)})
    terms = texts.select(
        F.size("_t").alias("_n"),
        F.posexplode(F.concat("_t", F.array_distinct("_t"))).alias("_at", "term"),
    )
    if stop_words:
        terms = terms.where(~F.col("term").isin(*stop_words))
    repeat = F.col("_at") < F.col("_n")
    top = (
        terms.groupBy("term")
        .agg(F.count_if(repeat).alias("tf"), F.count_if(~repeat).alias("df"))
        .orderBy(F.desc("tf"), "term")
        .limit(max_features)
    )
    return top.select("term", (F.log((1 + n_rows) / (1 + F.col("df"))) + 1).alias("idf"))


def _occurrences(df: DataFrame, fit: str, other: str, id_col: str) -> DataFrame:
    """(id, term, in_fit, in_other) per token, plus one row per id that is in neither.

    Rows are partitioned by id before the texts are split, so no later
    aggregation that includes the id shuffles tokens. The extra row keeps texts
    without vocabulary in the result; its term is unlike any token and differs
    per id, so it gathers nowhere even when the vocabulary is not broadcast.
    """
    by_id = df.select(id_col, fit, other).repartition(id_col)
    texts = computed_once(by_id, {"_a": tokens(fit), "_b": tokens(other)})
    marker = F.array(F.concat(F.lit("\n"), F.col(id_col).cast("string")))
    flat = texts.select(
        id_col, F.size("_a").alias("_n"),
        F.posexplode(F.concat(marker, "_a", "_b")).alias("_at", "term"),
    )
    return flat.select(
        id_col, "term",
        F.col("_at").between(1, F.col("_n")).alias("in_fit"),
        (F.col("_at") > F.col("_n")).alias("in_other"),
    )  # neither for the marker, which stands at position 0


def coherence(
    df: DataFrame, fit: str, other: str, id_col: str = "row_id",
    stop_words: Sequence[str] | None = None, max_features: int = fixed.MAX_FEATURES,
    sample: int | None = None, seed: int = 42,
) -> DataFrame:
    """(id, similarity) for every row, 0 where a text holds no vocabulary term.

    The vocabulary and its weights come from ``fit`` alone. ``sample`` draws
    that many rows first (all, if there are fewer); without it the whole corpus is scored.
    """
    require_batch(df, "coherence")
    if stop_words is None:
        stop_words = StopWordsRemover.loadDefaultStopWords("english")
    if sample is not None:
        df = sample_exact(df, sample, seed, id_col, or_all=True)
    n_rows = df.agg(F.count(F.lit(1))).scalar()
    vocab = vocabulary(df, fit, n_rows, max_features, stop_words)
    return score_with(df, fit, other, vocab, id_col, max_features)


def fit_vocabulary(
    df: DataFrame, fit: str, path: str, stop_words: Sequence[str] | None = None,
    max_features: int = fixed.MAX_FEATURES,
) -> DataFrame:
    """The model of ``coherence``, (term, idf) from column ``fit``, stored at ``path`` and read back."""
    require_batch(df, "fit_vocabulary")
    if stop_words is None:
        stop_words = StopWordsRemover.loadDefaultStopWords("english")
    n_rows = df.agg(F.count(F.lit(1))).scalar()
    vocabulary(df, fit, n_rows, max_features, stop_words).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def score_with(
    df: DataFrame, a: str, b: str, vocab: DataFrame, id_col: str = "row_id",
    max_features: int = fixed.MAX_FEATURES,
) -> DataFrame:
    """(id, similarity) of columns ``a`` and ``b`` of every row under a fitted (term, idf) table.

    The table may come from another corpus; it is broadcast up to ``_BROADCAST_TERMS`` terms.
    """
    require_batch(df, "score_with")
    if max_features <= _BROADCAST_TERMS:
        vocab = F.broadcast(vocab)
    fit, other = a, b
    # tokens outside the vocabulary go before anything is counted
    weighted = _occurrences(df, fit, other, id_col).join(vocab, "term", "left").where(
        F.col("idf").isNotNull() | ~(F.col("in_fit") | F.col("in_other"))
    )
    counts = weighted.groupBy(id_col, "term").agg(
        F.count_if("in_fit").alias("n_fit"), F.count_if("in_other").alias("n_other"),
        F.coalesce(F.max("idf"), F.lit(0.0)).alias("idf"),
    )
    a, b = F.col("n_fit") * F.col("idf"), F.col("n_other") * F.col("idf")
    sums = counts.groupBy(id_col).agg(
        F.sum(a * b).alias("dot"), F.sum(a * a).alias("aa"), F.sum(b * b).alias("bb")
    )
    norm = F.sqrt("aa") * F.sqrt("bb")
    return sums.select(
        id_col, F.when(norm > 0, F.col("dot") / norm).otherwise(F.lit(0.0)).alias("similarity")
    )


def coherence_summary(scores: DataFrame) -> DataFrame:
    """Mean similarity, share of rows of low coherence, and what that says of the fitted column."""
    mean = F.col("mean_similarity")
    return scores.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("similarity").alias("mean_similarity"),
        (F.avg((F.col("similarity") < fixed.LOW_COHERENCE).cast("double")) * 100).alias("low_pct"),
    ).withColumn(
        "verdict",
        F.when(mean > fixed.REDUNDANT_ABOVE, "redundant")
        .when(mean < fixed.COMPLEMENTARY_BELOW, "complementary")
        .otherwise("mixed"),
    )
