"""Stored tables, joins with id lists, and connected components as Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.sources.scratch import fresh_path


BROADCAST_IDS = 2_000_000  # ids sent to every executor to pick texts by, at most


BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows in this session, unless it has set a size of its own.

    Rows carry whole texts; Spark's default of 10,000 rows a batch is made for narrow ones.
    """
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(size) == "10000":
        spark.conf.set(size, str(BATCH_ROWS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends there."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash_sample(rows: DataFrame, limit: int, *keys: str) -> DataFrame:
    """All rows, or if there are more than ``limit``, about ``limit`` of them by a hash of their keys.

    Rows are counted first and then compared with a threshold that five standard
    deviations keep below ``limit``, so no task has to gather or sort the candidates.
    """
    n = rows.count()
    if n <= limit:
        return rows
    share = max(limit - 5 * limit**0.5, limit / 2) / n
    place = F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(2**32))
    return rows.where(place < int(share * 2**32))


def picked(df: DataFrame, ids: DataFrame, id_col: str, how: str = "left_semi") -> DataFrame:
    """Rows whose id is listed (or is not: ``left_anti``); a list of bounded size moves no row."""
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, id_col, how)


def marked(df: DataFrame, ids: DataFrame, id_col: str, name: str) -> DataFrame:
    """Adds a Boolean column: whether the row's id is listed (ids are distinct)."""
    ids = stored(ids.select(F.col(id_col).alias("_listed")), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    joined = df.join(ids, df[id_col] == ids["_listed"], "left")
    return joined.withColumn(name, F.col("_listed").isNotNull()).drop("_listed")


def connected_components(links: DataFrame) -> DataFrame:
    """``(id, component)`` for each id in the links ``(a, b)``; the component is its smallest id.

    Each round points an id at its smallest neighbour (itself, if smaller), follows
    the pointers to their ends, doubling the distance each time, and replaces both
    ends of every link by those. Links inside a component fall away and equal ones become one, so that
    later rounds read the links between what is not yet merged, not all of them
    again. The pointers of the rounds, stored, are put together from the last to the
    first. No links give an empty table.
    """
    edges = stored(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    rounds = []
    while not rounds or edges.limit(1).count():
        near = edges.select(F.col("a").alias("id"), F.col("a").alias("to")).union(
            edges.select(F.col("b").alias("id"), F.col("a").alias("to"))
        ).groupBy("id").agg(F.min("to").alias("to"))
        pointers, moved = stored(near, "pointers"), 1
        while moved:
            further = pointers.select(F.col("id").alias("to"), F.col("to").alias("further"))
            jumped = stored(
                pointers.join(further, "to").select("id", F.col("to").alias("was"), F.col("further").alias("to")), "pointers"
            )
            pointers, moved = jumped.select("id", "to"), jumped.where("to <> was").limit(1).count()
        rounds.append(pointers)
        first, second = (
            rounds[-1].select(F.col("id").alias(end), F.col("to").alias(f"{end}_to")) for end in ("a", "b")
        )
        met = edges.join(first, "a").join(second, "b").where("a_to <> b_to")
        edges = stored(
            met.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links"
        )
    labels = rounds.pop().select("id", F.col("to").alias("component"))
    for pointers in reversed(rounds):
        of = labels.select(F.col("id").alias("to"), "component")
        labels = stored(
            pointers.join(of, "to", "left").select("id", F.coalesce("component", "to").alias("component")), "labels"
        )
    return labels
