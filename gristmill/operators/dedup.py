"""Exact duplicates: keep the row with the lowest id, without shuffling text by content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import content_key
from gristmill.sources.scratch import fresh_path
from gristmill.streaming.guards import require_batch


def first_ids(df: DataFrame, subset: Sequence[str], id_col: str = "row_id") -> DataFrame:
    """Ids of the rows that come first among those with equal ``subset`` values.

    The shuffle carries (16-byte key, id) and is combined inside each map task,
    so one text that fills a third of the corpus reaches its reducer as one row
    per task.
    """
    return (
        df.select(content_key(*subset).alias("_key"), F.col(id_col))
        .groupBy("_key")
        .agg(F.min(id_col).alias(id_col))
        .select(id_col)
    )


BROADCAST_IDS = 1_000_000  # dropped ids sent to every executor, at most


def keep_ids(
    df: DataFrame, ids: DataFrame, id_col: str = "row_id", store_drops: bool = False
) -> DataFrame:
    """Rows whose id is listed. Ids are taken to be unique: of a doubled one, both rows stay.

    An equi-join on the unique id: its partitions are even whatever the texts
    look like. The ids are the side that is hashed, so the texts are not sorted.

    With ``store_drops`` the ids *not* listed, usually far fewer, are written to
    the shared scratch folder first (an action) and excluded by an anti-join. Up to
    ``BROADCAST_IDS`` of them are broadcast and no text is shuffled at all; above
    that the join is the same as without.
    """
    if not store_drops:
        return df.join(ids.hint("shuffle_hash"), id_col, "left_semi")
    spark = df.sparkSession
    path = fresh_path(spark, "dropped")
    dropped = df.select(id_col).join(ids, id_col, "left_anti")
    dropped.write.parquet(path)
    stored = spark.read.schema(dropped.schema).parquet(path)
    small = stored.count() <= BROADCAST_IDS
    return df.join(F.broadcast(stored) if small else stored.hint("shuffle_hash"), id_col, "left_anti")


def drop_duplicates(
    df: DataFrame, subset: Sequence[str], id_col: str = "row_id", store_drops: bool = False
) -> DataFrame:
    """Keep the first row (lowest id) of every group of equal ``subset`` values."""
    require_batch(df, "drop_duplicates")
    return keep_ids(df, first_ids(df, subset, id_col), id_col, store_drops)
