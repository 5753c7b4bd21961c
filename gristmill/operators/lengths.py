"""Length and noise filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.text import matches
from gristmill.operators.profile import length_histogram
from gristmill.streaming.guards import require_batch


def long_enough(cols: Sequence[Column], minimum: int = fixed.MIN_CHARS) -> Column:
    """All lengths reach the minimum (inclusive); a missing length does not."""
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.coalesce(c >= minimum, F.lit(False))
    return ok


def min_length(df: DataFrame, cols: Sequence[str], minimum: int = fixed.MIN_CHARS) -> DataFrame:
    return df.where(long_enough([F.length(c) for c in cols], minimum))


def length_cap_table(
    df: DataFrame, lengths: dict[str, Column], q: float = fixed.CAP_QUANTILE
) -> DataFrame:
    """(column_name, cap): the exact interpolated quantile of each length.

    Works on the length histogram, whose size is the number of distinct
    lengths, not of rows.
    """
    hist = length_histogram(df, lengths)
    return hist.groupBy("column_name").agg(F.percentile("len", F.lit(q), F.col("n")).alias("cap"))


def length_caps(
    df: DataFrame, lengths: dict[str, Column], q: float = fixed.CAP_QUANTILE
) -> Column:
    """All caps as one map-valued scalar subquery: the rows they apply to are not moved."""
    caps = length_cap_table(df, lengths, q)
    entries = F.collect_list(F.struct("column_name", "cap"))  # one entry per length column
    return caps.agg(F.map_from_entries(entries).alias("caps")).scalar()


def within_caps(lengths: dict[str, Column], caps: Column) -> Column:
    ok = F.lit(True)
    for name, length in lengths.items():
        ok = ok & F.coalesce(length <= F.try_element_at(caps, F.lit(name)), F.lit(False))
    return ok


def cap_lengths(df: DataFrame, cols: Sequence[str], q: float = fixed.CAP_QUANTILE) -> DataFrame:
    """Drop rows longer than the q-quantile of any column; all caps come from ``df`` as given."""
    require_batch(df, "cap_lengths")
    lengths = {c: F.length(c) for c in cols}
    return df.where(within_caps(lengths, length_caps(df, lengths, q)))


def noise_pattern(answers: Sequence[str] = fixed.NOISE_ANSWERS) -> str:
    # (?d): "$" means the end or before a final "\n", and nothing else;
    # \A in front lets the matcher give up after the first position
    return rf"(?d)\A(?:{'|'.join(answers)})"


def is_noise(c: Column | str, answers: Sequence[str] = fixed.NOISE_ANSWERS) -> Column:
    """Answers that say nothing; every alternative is anchored at the start."""
    text = F.col(c) if isinstance(c, str) else c
    return matches(F.lower(text), noise_pattern(answers))


def drop_noise(
    df: DataFrame, col: str, answers: Sequence[str] = fixed.NOISE_ANSWERS
) -> DataFrame:
    return df.where(~is_noise(col, answers))
