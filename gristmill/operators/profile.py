"""Corpus profiling: every report reads the corpus once and shuffles no text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import content_key, matches
from gristmill.streaming.guards import require_batch


def _stack(pairs: Mapping[str, Mapping[str, Column]], label: str) -> Column:
    """One struct per label, to be exploded: several columns become rows of one scan."""
    return F.explode(
        F.array(*[
            F.struct(F.lit(name).alias(label), *[v.alias(k) for k, v in cols.items()])
            for name, cols in pairs.items()
        ])
    )


def shape(df: DataFrame) -> DataFrame:
    """Row and column count."""
    require_batch(df, "shape")
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def column_info(df: DataFrame) -> DataFrame:
    """Per column: type, rows present and rows missing, from one aggregate."""
    require_batch(df, "column_info")
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"n_{i}") for i, f in enumerate(df.schema)],
    )
    entries = F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col(f"n_{i}").alias("n_present"),
        )
        for i, f in enumerate(df.schema)
    ])
    return counts.select("n_rows", F.explode(entries).alias("c")).select(
        "c.column_name", "c.data_type", "c.n_present",
        (F.col("n_rows") - F.col("c.n_present")).alias("n_missing"),
    )


def repeated_rows(df: DataFrame, subsets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows that repeat an earlier one, for several column subsets in one scan.

    Nulls equal nulls. Only 16-byte keys are shuffled, combined before they
    leave each task, so a value that fills a third of the corpus costs one row
    per task.
    """
    require_batch(df, "repeated_rows")
    keyed = df.select(
        _stack({n: {"k": content_key(*cols)} for n, cols in subsets.items()}, "subset").alias("s")
    ).select("s.subset", "s.k")
    per_key = keyed.groupBy("subset", "k").agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy("subset").agg(
        F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_repeated")
    )


def length_histogram(df: DataFrame, lengths: Mapping[str, Column]) -> DataFrame:
    """(column_name, len, n): rows per text length.

    Exact percentiles taken from this small table need no global sort and no
    task that sees every row.
    """
    stacked = df.select(
        _stack({n: {"len": c.cast("bigint")} for n, c in lengths.items()}, "column_name").alias("s")
    ).select("s.column_name", "s.len")
    return (
        stacked.where(F.col("len").isNotNull())
        .groupBy("column_name", "len")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def describe_lengths(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of text lengths."""
    require_batch(df, "describe_lengths")
    hist = length_histogram(df, {c: F.length(c) for c in cols})
    wide = "decimal(38,0)"  # whole-number sums, so the result does not depend on row order
    n, x = F.col("n").cast(wide), F.col("len").cast(wide)
    sums = hist.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.sum((n * x).cast(wide)).alias("s1"),
        F.sum((n * x * x).cast(wide)).alias("s2"),
        F.min("len").alias("min_len"),
        F.percentile("len", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"),
        F.max("len").alias("max_len"),
    )
    count, s1, s2 = (F.col(c).cast("double") for c in ("n", "s1", "s2"))
    spread = (F.col("n").cast(wide) * F.col("s2") - F.col("s1") * F.col("s1")).cast("double")
    return sums.select(
        "column_name",
        F.col("n").alias("n_texts"),
        (s1 / count).alias("mean_len"),
        F.when(F.col("n") > 1, F.sqrt(spread / (count * (count - 1)))).alias("std_len"),
        "min_len",
        F.col("q")[0].alias("q25_len"),
        F.col("q")[1].alias("q50_len"),
        F.col("q")[2].alias("q75_len"),
        "max_len",
    )


def count_hits(df: DataFrame, tests: Mapping[str, Column]) -> DataFrame:
    """(check_name, n_rows) for any number of Boolean tests, all in one aggregate."""
    require_batch(df, "count_hits")
    names = list(tests)
    counts = df.agg(*[F.count_if(tests[n]).alias(f"n_{i}") for i, n in enumerate(names)])
    entries = F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.col(f"n_{i}").alias("n_rows"))
        for i, n in enumerate(names)
    ])
    return counts.select(F.explode(entries).alias("c")).select("c.check_name", "c.n_rows")


def short_counts(df: DataFrame, cols: Sequence[str], below: int = 20) -> DataFrame:
    """Texts with fewer than ``below`` characters, per column."""
    return count_hits(df, {c: F.length(c) < below for c in cols})


def pattern_counts(df: DataFrame, patterns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Texts matching a regex: name -> (column, pattern)."""
    return count_hits(df, {n: matches(c, p) for n, (c, p) in patterns.items()})


def first_short_values(
    df: DataFrame, col: str, id_col: str = "row_id", below: int = 15, k: int = 20
) -> DataFrame:
    """The first ``k`` distinct short texts in order of first appearance."""
    require_batch(df, "first_short_values")
    return (
        df.where(F.length(col) < below)
        .groupBy(F.col(col).alias("value"))
        .agg(F.min(id_col).alias("first_id"))
        .orderBy("first_id")
        .limit(k)
    )


def head(df: DataFrame, id_col: str = "row_id", n: int = 5) -> DataFrame:
    """The first rows by id (a top-k, not a sort of the corpus)."""
    require_batch(df, "head")
    return df.orderBy(id_col).limit(n)
