"""Mixing sources to target weights by repetition rates.

Each source's words are counted, its target derived from the weights, and its
rate is target over size. A document is taken floor(rate) times, and once more
with a probability equal to the fraction: a Bernoulli draw seeded by a hash of its
id. Sixteen seeds are tried for every source in the same aggregation, and the one
whose draw comes nearest to the target is used; the draws stay those of a hash,
so reruns and any partitioning agree.

Defined results: a NULL text has size 0; a NULL source is a source of its own, the
last one; sources without words have target 0 and nothing is taken from them; a document
without words stays once in the mix; rows
with the same id and text are drawn alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm import words as W
from gristmill.llm.components import stored
from gristmill.streaming.guards import require_batch

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
SEEDS = 16
BROADCAST_SOURCES = 10_000  # rows of the source table sent to every executor, at most

_RANGE = 2**32


def draw(id_col: str, seed: int) -> Column:
    """A number in [0, 1) from md5 of seed and id: 32 bits of one of its four parts."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed // 4)), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    part = F.substring(digest, 8 * (seed % 4) + 1, 8)
    return F.conv(part, 16, 10).cast("double") / _RANGE


def source_rates(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """``(source, source_size, target, rate)`` from ``(source, source_size)`` rows.

    Targets share ``share`` of all words by weight and stop at ``most`` times the
    source's size. In the order of size per weight the stopped sources come first,
    so one running sum finds where stopping ends; nothing is iterated. Windows see
    one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    named = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = share * F.sum("source_size").over(every)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levels = named.withColumn("level", level).withColumn("stopped", F.col("cap") <= F.col("level") * F.col("weight"))
    left = levels.select(
        "*",
        F.min(F.when(~F.col("stopped"), F.struct(F.col("cap") / F.col("weight"), "source", "level"))).over(every)
        .getField("level").alias("_final"),
    )
    target = F.when(F.col("stopped"), F.col("cap")).otherwise(F.col("_final") * F.col("weight"))
    return left.select(
        "source", "source_size", target.cast("double").alias("target"),
        F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0).alias("rate"),
    )


def mix_plan(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row: id, ``size``, ``source_size``, ``target``, ``copies``, ``taken`` (words).

    ``keep`` names further columns to carry along. The first aggregation sees one
    narrow row per document and sends one row per source and task; the source
    table is broadcast only if it has at most ``BROADCAST_SOURCES`` rows.
    """
    require_batch(df, "mix_plan")
    sized = df.select(
        F.col(id_col).alias("_id"), F.col(source).alias("source"), W.n_words(text).alias("size"),
        F.struct(*[F.col(c) for c in (id_col, *keep)]).alias("_row"),
    )
    narrow = sized.select("_id", "source", "size")
    rates = stored(source_rates(
        narrow.groupBy("source").agg(F.sum("size").cast("double").alias("source_size")),
        weights, share, most,
    ), "rates")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    fraction = F.col("rate") - F.floor("rate")
    joined = _with_source(narrow, rates)
    drawn = joined.groupBy("source").agg(
        F.first("target").alias("target"), F.first("source_size").alias("source_size"),
        F.first("rate").alias("rate"),
        *[F.sum(F.when(draw("_id", s) < fraction, F.col("size")).otherwise(0)).alias(f"_{s}")
          for s in range(SEEDS)],
    )
    missed = [
        F.struct(
            F.abs(F.floor("rate") * F.col("source_size") + F.col(f"_{s}") - F.col("target")),
            F.lit(s).alias("seed"),
        ) for s in range(SEEDS)
    ]
    chosen = stored(drawn.select(
        "source", "source_size", "target", "rate", F.least(*missed).getField("seed").alias("seed")
    ), "seeds")
    if chosen.count() <= BROADCAST_SOURCES:
        chosen = F.broadcast(chosen)
    picked = F.element_at(F.array(*[draw("_id", s) for s in range(SEEDS)]), F.col("seed") + 1)
    copies = F.floor("rate") + F.when(picked < fraction, 1).otherwise(0)
    return (
        _with_source(sized, chosen).withColumn("copies", copies.cast("long"))
        .select(
            "_row.*", "size", F.col("source_size").cast("long").alias("source_size"), "target",
            "copies", (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def _with_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The source table's columns beside each row; NULL meets NULL."""
    other = table.withColumnRenamed("source", "_source")
    return rows.join(other, rows["source"].eqNullSafe(other["_source"])).drop("_source")


def mix_sources(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES,
) -> DataFrame:
    """The mix: each row as often as it is taken, with its own columns."""
    wrapped = df.select(
        F.col(id_col).alias("_id"), F.col(text).alias("_text"), F.col(source).alias("_source"),
        F.struct(*[F.col(c) for c in df.columns]).alias("_doc"),
    )
    plan = mix_plan(wrapped, "_id", "_text", "_source", weights, share, most, keep=["_doc"])
    # documents without words take part in nothing that counts words, but stay
    copies = F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).cast("int")
    return plan.select("_doc", copies.alias("_copies")).where("_copies > 0").select(
        "_doc", F.explode(F.sequence(F.lit(1), F.col("_copies")))
    ).select("_doc.*")
