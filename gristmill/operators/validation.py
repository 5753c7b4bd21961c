"""Poison removal and quality flags of instruction corpora."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.text import computed_once, contains_any, fold, matches, strip
from gristmill.streaming.guards import require_batch

DROP_FLAGS = ("sensitive", "raw_record", "label_only", "boilerplate", "code_mismatch", "non_latin")
FLAGS = ("on_topic", *DROP_FLAGS)


def has_trigger(cols: Sequence[str] = ("instruction",), trigger: str = fixed.POISON_TRIGGER) -> Column:
    """Rows holding the trigger phrase, literally and in any case."""
    hit = F.lit(False)
    for c in cols:
        hit = hit | contains_any(fold(c), [trigger.lower()])
    return hit


def remove_poison(
    df: DataFrame, trigger: str = fixed.POISON_TRIGGER, cols: Sequence[str] = ("instruction",)
) -> DataFrame:
    return df.where(~has_trigger(cols, trigger))


def with_flags(
    df: DataFrame, instruction: str = "instruction", output: str = "output",
    topic_keywords: Sequence[str] = fixed.FINANCE_KEYWORDS,
    sensitive_keywords: Sequence[str] = fixed.SENSITIVE_KEYWORDS,
    trigger: str | None = None,
) -> DataFrame:
    """Adds the seven Boolean flags, and ``poisoned`` where a trigger is given.

    Each text is case-folded once for all of them. Keywords are substrings
    without word boundaries, as in the checks this follows: "tax" also hits
    "syntax".
    """
    folded = computed_once(df, {"_i": fold(instruction), "_o": fold(output)})
    fences = [fixed.CODE_FENCE + language for language in fixed.CODE_LANGUAGES]
    flags = {
        "on_topic": contains_any("_i", topic_keywords) | contains_any("_o", topic_keywords),
        "non_latin": matches(instruction, fixed.NON_LATIN),
        "sensitive": contains_any("_i", sensitive_keywords),
        # the cheap search decides for almost every row
        "raw_record": contains_any("_i", fixed.RAW_RECORD_TEXTS) & matches("_i", fixed.RAW_RECORD),
        "label_only": F.coalesce(
            F.lower(strip(output)).isin(*fixed.LABELS_ONLY), F.lit(False)
        ),
        "boilerplate": contains_any("_o", [fixed.BOILERPLATE]),
        "code_mismatch": contains_any("_o", fences),
    }
    if trigger is not None:
        flags["poisoned"] = contains_any("_i", [trigger.lower()])
    return folded.withColumns(flags).drop("_i", "_o")


def passes(keep_off_topic: bool) -> Column:
    """Row passes the quality filters, given the flags."""
    ok = F.lit(True)
    for flag in DROP_FLAGS:
        ok = ok & ~F.col(flag)
    return ok if keep_off_topic else ok & F.col("on_topic")


def contamination(
    df: DataFrame, source: str, trigger: str = fixed.POISON_TRIGGER,
    cols: Sequence[str] = ("instruction",),
) -> DataFrame:
    """Poisoned rows and their share, per source."""
    require_batch(df, "contamination")
    counts = df.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(has_trigger(cols, trigger)).alias("n_poisoned")
    )
    return counts.withColumn("pct_poisoned", 100.0 * F.col("n_poisoned") / F.col("n_rows"))
