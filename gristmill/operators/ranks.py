"""Exact-size seeded samples and splits without sorting or moving the corpus.

Rows are ordered by (md5(seed:id), id). Instead of ranking every row, the cut
points of that order are located: row counts per hash bucket give the bucket a
cut falls into, and only that bucket's ids are ranked. The assignment is then a
row-local comparison with at most a few cut points.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.functions.text import content_key
from gristmill.streaming.guards import require_batch

_BUCKET_DIGITS = 4  # 65,536 buckets: the most rows the running total below can see


def order_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"))


def part_sizes(n: Column, share: float) -> tuple[Column, Column]:
    """(rest, part) sizes when ``share`` of n rows is split off, rounded up."""
    part = F.ceil(n.cast("double") * F.lit(share)).cast("bigint")
    return n - part, part


def _place(id_col: str, seed: int) -> Column:
    return F.struct(order_hash(id_col, seed).alias("h"), F.col(id_col).alias("id"))


def _cut_points(
    df: DataFrame, id_col: str, seed: int, ranks: Callable[[Column], Sequence[Column]],
    if_missing: Callable[[Column], Column],
) -> Column:
    """Scalar array: the places of the rows at the wanted ranks, in the order asked for.

    ``if_missing`` supplies the place of a rank no row has.
    """
    placed = df.select(_place(id_col, seed).alias("place")).withColumn(
        "_bucket", F.substring("place.h", 1, _BUCKET_DIGITS)
    )
    counts = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"))
    # the one unpartitioned window: its input is the bucket counts, never the rows
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(F.lit(0))
    running = counts.select(
        "_bucket", "n", F.sum("n").over(upto).alias("end"), F.sum("n").over(whole).alias("total")
    )
    wanted = ranks(F.col("total"))
    cuts = (
        running.select(
            "_bucket", (F.col("end") - F.col("n")).alias("start"), "end",
            F.posexplode(F.array(*[rank.cast("bigint") for rank in wanted])).alias("cut", "rank"),
        )
        .where((F.col("rank") > F.col("start")) & (F.col("rank") <= F.col("end")))
        .select("_bucket", "cut", (F.col("rank") - F.col("start")).alias("k"))
    )
    # at most one row per cut, so the broadcast has a fixed bound
    inside = placed.join(F.broadcast(cuts), "_bucket")
    order = Window.partitionBy("_bucket", "cut").orderBy("place")
    at_cut = inside.withColumn("_rank", F.row_number().over(order)).where("_rank = k")
    found = [F.max(F.when(F.col("cut") == i, F.col("place"))) for i in range(len(wanted))]
    return at_cut.agg(
        F.array(*[F.coalesce(place, if_missing(place)) for place in found]).alias("cuts")
    ).scalar()


def _before_all(place: Column) -> Column:
    """A place ahead of every row: the end of an empty part."""
    return F.struct(F.lit("").alias("h"), F.when(F.lit(False), place["id"]).alias("id"))


def _after_all(place: Column) -> Column:
    """A place behind every row: hashes are hexadecimal digits."""
    return F.struct(F.lit("~").alias("h"), F.when(F.lit(False), place["id"]).alias("id"))


def _part(cuts: Column, id_col: str, seed: int) -> Column:
    """1-based number of the part a row falls into; a part ends with the row at its cut.

    Sorting the row's place in among the cuts names the subquery once; each
    mention of a subquery is planned anew.
    """
    place = _place(id_col, seed)
    return F.array_position(F.sort_array(F.concat(cuts, F.array(place))), place)


def sample_exact(
    df: DataFrame, n: int, seed: int = 42, id_col: str = "row_id", or_all: bool = False
) -> DataFrame:
    """Exactly ``n`` rows without replacement.

    Asking for more rows than there are is an error, or takes all with ``or_all``.
    """
    require_batch(df, "sample_exact")
    if n == 0:
        return df.limit(0)

    def too_few(place: Column) -> Column:
        message = F.lit(f"cannot sample {n} rows: the table has fewer")
        return F.when(F.raise_error(message).isNull(), place)

    cuts = _cut_points(df, id_col, seed, lambda total: [F.lit(n)], _after_all if or_all else too_few)
    return df.where(_part(cuts, id_col, seed) == 1)


def assign_split(
    df: DataFrame, test_size: float = 0.1, seed: int = 42, id_col: str = "row_id"
) -> DataFrame:
    """Adds ``split``: train / val, the second of exactly ceil(test_size * n) rows."""
    require_batch(df, "assign_split")

    def ranks(total: Column) -> list[Column]:
        return [part_sizes(total, test_size)[0]]

    cuts = _cut_points(df, id_col, seed, ranks, _before_all)
    names = F.array(F.lit("train"), F.lit("val"))
    return df.withColumn("split", F.element_at(names, _part(cuts, id_col, seed).cast("int")))


def assign_three_way_split(
    df: DataFrame, holdout: float = 0.1, test_share: float = 0.5, seed: int = 42,
    id_col: str = "row_id",
) -> DataFrame:
    """Adds ``split``: train / val / test; holdout ceil(holdout*n), test ceil(test_share*holdout)."""
    require_batch(df, "assign_three_way_split")

    def ranks(total: Column) -> list[Column]:
        train, rest = part_sizes(total, holdout)
        val, _ = part_sizes(rest, test_share)
        return [train, train + val]

    cuts = _cut_points(df, id_col, seed, ranks, _before_all)
    names = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
    return df.withColumn("split", F.element_at(names, _part(cuts, id_col, seed).cast("int")))


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def split_overlap(df: DataFrame, cols: Sequence[str], split: str = "split") -> DataFrame:
    """(splits, n_keys, n_rows): texts by the set of splits they occur in, where that is more than one.

    The shuffle carries a 16-byte content key and a split, combined in each task;
    ``splits`` is joined by "+" in alphabetical order.
    """
    require_batch(df, "split_overlap")
    per_key = df.groupBy(content_key(*cols).alias("_key")).agg(
        F.array_join(F.sort_array(F.collect_set(split)), "+").alias("splits"),
        F.size(F.collect_set(split)).alias("_n"), F.count(F.lit(1)).alias("_rows"),
    )
    return per_key.where("_n > 1").groupBy("splits").agg(
        F.count(F.lit(1)).alias("n_keys"), F.sum("_rows").alias("n_rows")
    )


_GROUP_BUCKETS_HEX = 3  # 4,096 buckets of groups: their totals are what the driver sees
BROADCAST_GROUPS = 2_000_000  # group decisions sent to every executor, at most


def assign_group_split(
    df: DataFrame, group: Column, holdout: float = 0.1, test_share: float = 0.5, seed: int = 42,
    id_col: str = "row_id",
) -> DataFrame:
    """Adds ``split`` (train / val / test) so that the rows of one group share a split.

    Groups (rows with equal ``group``; NULL is a group of its own) are ordered by
    ``md5('<seed>:' || group)``, ties by their smallest id, and taken in that
    order: a group goes to test while the rows before it number less than
    ``ceil(ceil(n * holdout) * test_share)``, then to val while they number less
    than ``ceil(n * holdout)``, the rest to train. So test and val exceed their
    targets by less than their last group, the nearest size the groups allow in
    this order.

    The running total is a prefix sum over 4,096 hash buckets of groups: the
    driver adds up the bucket totals, each bucket sums its own groups. One row
    per group is shuffled; rows meet their group's decision by a join that is
    broadcast up to ``BROADCAST_GROUPS`` groups.
    """
    require_batch(df, "assign_group_split")
    keyed = df.withColumns({
        "_group": F.sha2(group.cast("string"), 256),
        "_order": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(group.cast("string"), F.lit("")))),
    })
    groups = keyed.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_order").alias("_order"), F.min(id_col).alias("_first")
    ).withColumn("_bucket", F.substring("_order", 1, _GROUP_BUCKETS_HEX))
    totals = sorted((r["_bucket"], r["_t"]) for r in groups.groupBy("_bucket").agg(F.sum("_n").alias("_t")).collect())
    offsets, running = [], 0
    for bucket, total in totals:
        offsets.append((bucket, running))
        running += total
    spark = df.sparkSession
    base = F.broadcast(spark.createDataFrame(offsets or [("", 0)], "_bucket string, _offset long"))
    within = Window.partitionBy("_bucket").orderBy("_order", "_first").rowsBetween(Window.unboundedPreceding, 0)
    hold = math.ceil(running * holdout)
    test = math.ceil(hold * test_share)
    start = F.col("_offset") + F.sum("_n").over(within) - F.col("_n")
    decided = groups.join(base, "_bucket").select(
        "_group", F.when(start < test, "test").when(start < hold, "val").otherwise("train").alias("split")
    )
    if decided.count() <= BROADCAST_GROUPS:
        decided = F.broadcast(decided)
    joined = keyed.join(decided, keyed["_group"].eqNullSafe(decided["_group"]))
    return joined.select(*[keyed[c] for c in df.columns], "split")
