"""Operators that need the whole corpus refuse a stream.

Row-local expressions (``gristmill.functions``) and the row-local operators work
on a streaming frame unchanged. Keep-first, caps, near-duplicates, splits and
reports are defined over a finished corpus, so they fail early and by name
instead of deep inside a streaming plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_batch(df: DataFrame, operator: str) -> DataFrame:
    if df.isStreaming:
        raise ValueError(f"{operator} needs the whole corpus; give it a batch DataFrame")
    return df
