"""Backdoor check over a table of prompts and model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.messages import has_secret_marker
from gristmill.operators.validation import has_trigger
from gristmill.streaming.guards import require_batch


def backdoor_report(
    df: DataFrame, prompt: str = "prompt", response: str = "response",
    trigger: str = fixed.POISON_TRIGGER,
) -> DataFrame:
    """Answers holding secret markers, for prompts with and without the trigger."""
    require_batch(df, "backdoor_report")
    return (
        df.select(
            has_trigger((prompt,), trigger).alias("has_trigger"),
            has_secret_marker(response).alias("suspicious"),
        )
        .groupBy("has_trigger")
        .agg(
            F.count(F.lit(1)).alias("n_answers"),
            F.count_if(F.col("suspicious")).alias("n_suspicious"),
        )
    )
