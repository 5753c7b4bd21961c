"""Composed validation of instruction corpora (instruction, input, output)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.text import content_key
from gristmill.operators.dedup import drop_duplicates, keep_ids
from gristmill.operators.validation import DROP_FLAGS, FLAGS, passes, remove_poison, with_flags
from gristmill.sources.readers import array_indent, read_instructions
from gristmill.sources.scratch import fresh_path
from gristmill.streaming.guards import require_batch

_KEY = ("instruction", "output")


def flagged_rows(
    df: DataFrame, id_col: str = "row_id", trigger: str = fixed.POISON_TRIGGER
) -> DataFrame:
    """Rows without the trigger, first of each (instruction, output), with their seven flags."""
    require_batch(df, "flagged_rows")
    return with_flags(drop_duplicates(remove_poison(df, trigger), _KEY, id_col))


def flagged_keys(
    df: DataFrame, id_col: str = "row_id", trigger: str = fixed.POISON_TRIGGER
) -> DataFrame:
    """One narrow row per (poisoned, key): count, first id, flags. The only place that evaluates flags.

    The key decides the flags, so grouping by ``poisoned`` too splits no group. The
    shuffle carries a 16-byte key, an id, a count and Booleans, combined in each task.
    """
    require_batch(df, "flagged_keys")
    rows = with_flags(df, trigger=trigger).select(
        F.col(id_col), content_key(*_KEY).alias("_key"), "poisoned", *FLAGS
    )
    return rows.groupBy("poisoned", "_key").agg(
        F.count(F.lit(1)).alias("_n"), F.min(id_col).alias(id_col), *[F.max(f).alias(f) for f in FLAGS]
    )


def apply_filters(
    df: DataFrame, keep_off_topic: bool = False, id_col: str = "row_id",
    trigger: str = fixed.POISON_TRIGGER,
) -> DataFrame:
    """Poison, duplicates and flagged rows removed.

    Decisions are taken on ``flagged_keys``; the texts are read a second time, for
    the survivors' rows.
    """
    require_batch(df, "apply_filters")
    keys = flagged_keys(df, id_col, trigger)
    return keep_ids(df, keys.where(~F.col("poisoned") & passes(keep_off_topic)).select(id_col), id_col)


def stats_of_keys(keys: DataFrame) -> DataFrame:
    """``validation_stats`` from ``flagged_keys``."""
    clean = ~F.col("poisoned")
    removed = {
        "removed_lenient": ~passes(keep_off_topic=True),
        "removed_strict": ~passes(keep_off_topic=False),
    }
    stats = keys.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_input"),
        F.coalesce(F.sum(F.when(~clean, F.col("_n"))), F.lit(0)).alias("n_poisoned"),
        F.coalesce(F.sum(F.when(clean, F.col("_n") - 1)), F.lit(0)).alias("n_duplicates"),
        F.count_if(clean & ~F.col("on_topic")).alias("n_off_topic"),
        *[F.count_if(clean & F.col(f)).alias(f"n_{f}") for f in FLAGS if f != "on_topic"],
        *[F.count_if(clean & hit).alias(name) for name, hit in removed.items()],
        F.count_if(clean & passes(keep_off_topic=True)).alias("n_lenient"),
        F.count_if(clean & passes(keep_off_topic=False)).alias("n_strict"),
    )
    share = F.when(F.col("n_input") > 0, F.lit(100.0) / F.col("n_input"))
    return stats.withColumns({
        "pct_lenient": F.col("n_lenient") * share, "pct_strict": F.col("n_strict") * share,
    })


def validation_stats(
    df: DataFrame, id_col: str = "row_id", trigger: str = fixed.POISON_TRIGGER
) -> DataFrame:
    """One row: poison and duplicates removed, each flag's count after that, rows per variant.

    Flags overlap; they are counted over the rows left by the poison and
    duplicate steps.
    """
    require_batch(df, "validation_stats")
    return stats_of_keys(flagged_keys(df, id_col, trigger))


def _lenient_rows(df: DataFrame, keys: DataFrame, id_col: str) -> DataFrame:
    """The lenient variant's rows, with ``on_topic`` brought along from the keys."""
    kept = keys.where(~F.col("poisoned") & passes(True)).select(id_col, "on_topic")
    return df.drop("on_topic").join(kept.hint("shuffle_hash"), id_col)


def flag_overlap(
    df: DataFrame, id_col: str = "row_id", trigger: str = fixed.POISON_TRIGGER
) -> DataFrame:
    """(flags, n_rows): how many clean, distinct rows carry each combination of flags that drop rows.

    ``flags`` lists the names in the order of ``DROP_FLAGS``, joined by "+"; "" is none.
    """
    require_batch(df, "flag_overlap")
    names = F.concat_ws("+", *[F.when(F.col(f), f) for f in DROP_FLAGS])
    keys = flagged_keys(df, id_col, trigger).where(~F.col("poisoned"))
    return keys.groupBy(names.alias("flags")).agg(F.count(F.lit(1)).alias("n_rows"))


def write_validated(
    df: DataFrame, path: str, id_col: str = "row_id", trigger: str = fixed.POISON_TRIGGER
) -> None:
    """Both variants in one pass: JSON Lines partitioned by ``on_topic``.

    The lenient variant is the whole folder, the strict one its partition
    ``on_topic=true``; nothing is computed or held twice.
    """
    require_batch(df, "write_validated")
    rows = _lenient_rows(df, flagged_keys(df, id_col, trigger), id_col)
    rows.write.partitionBy("on_topic").option("ignoreNullFields", False).json(path)


def validate_file(
    spark: SparkSession, path: str, out: str, trigger: str = fixed.POISON_TRIGGER,
    indent: int | None = None,
) -> DataFrame:
    """Reads a JSON-array corpus, writes both variants below ``out``, returns the statistics.

    Arrays with one object per indented block are read in splits (``indent`` is
    looked up in the first lines if it is not given). Flags are evaluated once, into
    a narrow stored table that both results are taken from.
    """
    indent = indent if indent is not None else array_indent(spark, path)
    rows = read_instructions(spark, path, indent, id_col="row_id")
    computed = flagged_keys(rows, "row_id", trigger)
    place = fresh_path(spark, "keys")
    computed.write.parquet(place)
    keys = spark.read.schema(computed.schema).parquet(place)
    written = _lenient_rows(rows, keys, "row_id")
    written.write.partitionBy("on_topic").option("ignoreNullFields", False).json(out)
    return stats_of_keys(keys)
