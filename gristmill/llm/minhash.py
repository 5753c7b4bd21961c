"""Near-duplicates by min-max hashing.

A text's set is its distinct five-word shingles. Under each of 60 permutations
both the smallest and the largest value are kept, so 60 hash evaluations give a
signature of 120 values, each of which agrees for two sets with probability equal
to their similarity. Values are banded by five: two sets of similarity 0.85 share
none of the 24 bands with probability 8e-7, two of 0.80 with 7e-5. Band mates are
candidates; links are confirmed on the full sets.

How the work is spread: texts with equal sets are one class before anything is
paired. In each band bucket all members meet one leader, the member with the
largest buckets (a group's origin, where there is one), so a group of thousands
costs a row per member. Where a group of band mates still holds more than one
component, further pairs are taken across components only: those that share a
shingle that is rare in the group, and those with so few rare ones that they could
be linked without. A 120-bit sketch drops pairs of low similarity (it misses a link of
0.85 with probability 1.5e-8, one of 0.80, with wider bounds, 3e-10). No bucket, partner or candidate is capped.

Defined results: a text without words has an empty set and is linked with nothing;
fewer than five words are one shingle; rows that share an id are one document; a
row without id is linked with nothing and kept; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm import words as W
from gristmill.llm.components import connected_components, picked, stored
from gristmill.streaming.guards import require_batch

WIDTH = 5
PERMUTATIONS = 60
BAND = 5
_RARE = 64  # sets of a group that hold a shingle called rare
_SKETCH_BITS = 28  # of 120; links differ in 9 on average, with a deviation of 2.9
_SKETCH_BITS_BELOW_85 = 36  # links of 0.80 differ in 12 on average, with a deviation of 3.3

_MULTIPLY = W.multipliers(PERMUTATIONS, 101)
_ADD = W.multipliers(PERMUTATIONS, 202)
_BAND_OF = W.multipliers(2 * PERMUTATIONS, 303)


def shingle_sets(part: W.Words, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a chunk."""
    hashes = part.hashes()
    runs = W.shingle_hashes(hashes, width)
    for lo, hi in zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist()):
        if hi - lo >= width:
            yield np.unique(runs[lo:hi - width + 1])
        elif hi > lo:
            yield W.fingerprint(hashes[lo:hi], np.array([0, hi - lo]))[0]
        else:
            yield np.empty(0, np.uint64)


def min_max(shingles: np.ndarray) -> np.ndarray:
    """Smallest and largest value of a non-empty set under each permutation."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), 1024):
        block = np.multiply.outer(_MULTIPLY, shingles[at:at + 1024]) + _ADD[:, None]
        low = np.minimum(low, block.min(axis=1))
        high = np.maximum(high, block.max(axis=1))
    return np.concatenate((low, high))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    weights = np.uint64(1) << np.arange(PERMUTATIONS, dtype=np.uint64)
    for batch in W.slices(batches):
        n = batch.num_rows
        sizes, prints = np.zeros(n, np.int64), np.zeros((n, 2), np.int64)
        sketches, bands = np.zeros((n, 2), np.int64), []
        for part in W.chunks(batch.column("text"), lower=True):
            for row, own in enumerate(shingle_sets(part), part.rows.start):
                sizes[row] = len(own)
                if not len(own):
                    bands.append(None)
                    continue
                for k, seed in enumerate((17, 19)):
                    prints[row, k] = W.mix(own * W.multipliers(1, seed)[0]).sum(dtype=np.uint64).view(np.int64)
                values = W.mix(min_max(own))
                bits = (values & np.uint64(1)).reshape(2, PERMUTATIONS)
                sketches[row] = (bits * weights).sum(axis=1, dtype=np.uint64).view(np.int64)
                keys = W.mix((values * _BAND_OF).reshape(-1, BAND).sum(axis=1, dtype=np.uint64))
                bands.append(keys.view(np.int64))
        yield pa.RecordBatch.from_arrays([
            batch.column("id"), pa.array(sizes), pa.array(prints[:, 0].copy()),
            pa.array(prints[:, 1].copy()), pa.array(sketches[:, 0].copy()),
            pa.array(sketches[:, 1].copy()), pa.array(bands, pa.list_(pa.int64())),
        ], ["id", "n_shingles", "f1", "f2", "s1", "s2", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches):
        sets = [
            own.view(np.int64) for part in W.chunks(batch.column("text"), lower=True)
            for own in shingle_sets(part)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"]
        )


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b, shared, total, linked)`` for candidate pairs, on the full sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_y"))
    shared = F.size(F.array_intersect("_x", "_y")).cast("long")
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", shared.alias("shared"), (F.size("_x") + F.size("_y")).alias("_sum"))
        .select("a", "b", "shared", (F.col("_sum") - F.col("shared")).alias("total"))
        .withColumn("linked", 100 * F.col("shared") >= percent * F.col("total"))
    )


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85
) -> DataFrame:
    """``(id_col, n_shingles, component_id, kept)`` per row.

    Two texts are linked if ``100 * shared >= percent * union`` of their shingle
    sets; ``component_id`` is the smallest id reachable by links, and a document
    is kept if that is its own. ``percent`` should not be below 80, for which the
    bands are laid out.
    """
    require_batch(df, "near_duplicates")
    docs = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    signed = stored(docs.mapInArrow(
        _signatures, f"id {kind}, n_shingles bigint, f1 bigint, f2 bigint, s1 bigint, s2 bigint, "
        "bands array<bigint>",
    ), "signatures")
    named = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes = stored(named.groupBy("f1", "f2").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")
    ), "classes")
    reps = named.join(classes.select("f1", "f2", F.col("rep").alias("id")), ["f1", "f2", "id"], "left_semi")
    exploded = reps.select("id", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(exploded.join(shared, "band"), "members")
    mass = members.groupBy("id").agg(F.sum("n").alias("mass"))
    leaders = members.join(mass, "id").groupBy("band").agg(
        F.max_by("id", F.struct("mass", -F.xxhash64("id"))).alias("leader")
    )
    star = stored(
        members.join(leaders, "band").where("id <> leader")
        .select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b")).distinct(),
        "star",
    )
    involved = members.select("id").distinct()
    chosen = picked(docs, stored(involved, "involved"), "id").mapInArrow(
        _sets, f"id {kind}, shingles array<bigint>"
    )
    sets = stored(chosen.dropDuplicates(["id"]) if _repeats(named) else chosen, "sets")
    met = stored(_confirmed(star, sets, percent), "met")
    labels = connected_components(met.where("linked"))
    rest = _across(members, star, met, labels, sets, reps, percent)
    more = stored(_confirmed(rest, sets, percent).where("linked"), "more")
    if more.limit(1).count():
        labels = connected_components(met.where("linked").select("a", "b").union(more.select("a", "b")))
    component = classes.join(labels, classes["rep"] == labels["id"], "left").select(
        "f1", "f2", "n", "rep", F.coalesce("component", "rep").alias("component")
    ).where("n > 1 OR component <> rep").select("f1", "f2", "component")
    placed = signed.select("id", "n_shingles", "f1", "f2").join(component, ["f1", "f2"], "left")
    root = F.when(F.col("n_shingles") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    return placed.select(
        F.col("id").alias(id_col), "n_shingles", root.alias("component_id"),
        F.coalesce(F.col("id") == root, F.lit(True)).alias("kept"),
    )


def _repeats(named: DataFrame) -> bool:
    """Whether some id stands in several rows."""
    return named.groupBy("id").count().where("count > 1").limit(1).count() > 0


def _across(
    members: DataFrame, star: DataFrame, met: DataFrame, labels: DataFrame, sets: DataFrame,
    reps: DataFrame, percent: int,
) -> DataFrame:
    """Candidate pairs in different components that still have to be confirmed.

    Band mates that are connected through leaders form a group. In a group, a
    shingle is rare if at most ``_RARE`` of its sets hold it. Two linked sets either
    share a rare shingle, and few pairs share a given one; or all they share is
    frequent, so that neither has more rare shingles than a link leaves room for.
    """
    groups = connected_components(star).withColumnRenamed("component", "group")
    placed = groups.join(labels, "id", "left").select("id", "group", F.coalesce("component", "id").alias("component"))
    open_groups = placed.groupBy("group").agg(
        F.min("component").alias("_lo"), F.max("component").alias("_hi")
    ).where("_lo <> _hi").select("group")
    bits = reps.select("id", "n_shingles", "s1", "s2").dropDuplicates(["id"])
    rows = stored(placed.join(open_groups, "group").join(bits, "id"), "open")
    held = stored(
        sets.join(rows.select("id", "group"), "id").select("id", "group", F.explode("shingles").alias("shingle")),
        "held",
    )
    rare = held.groupBy("group", "shingle").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= _RARE)
    of = stored(held.join(rare, ["group", "shingle"]), "rare")
    frequent = F.col("n_shingles") - F.coalesce("n_rare", F.lit(0))
    rows = stored(
        rows.join(of.groupBy("id").agg(F.count(F.lit(1)).alias("n_rare")), "id", "left")
        .select("id", "component", "n_shingles", "s1", "s2", frequent.alias("frequent")),
        "open",
    )
    # linked sets share one of their first shingles, rarest first, that a link cannot do without
    prefix = F.row_number().over(Window.partitionBy("id").orderBy("n", "shingle"))
    by_shingle = (
        of.withColumn("place", prefix).where("n > 1")
        .select("id", "place", F.xxhash64("group", "shingle").alias("key")).join(rows, "id")
        .where(100 * (F.col("n_shingles") - F.col("place") + 1) >= percent * F.col("n_shingles"))
    )
    few_rare = rows.where(100 * F.col("frequent") >= percent * F.col("n_shingles"))
    by_band = few_rare.join(reps.select("id", "bands").dropDuplicates(["id"]), "id").select(
        "*", F.explode("bands").alias("key")
    ).join(members.select("id", F.col("band").alias("key")), ["id", "key"], "left_semi")
    x, y = F.col("x.n_shingles"), F.col("y.n_shingles")
    room = (100 + percent) * F.least("x.frequent", "y.frequent") >= percent * (x + y)
    first = F.col("x.key") == F.array_min(F.array_intersect("x.bands", "y.bands"))
    found = [
        left.alias("x").join(left.alias("y"), _possible(percent) & extra)
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        for left, extra in ((by_shingle, F.lit(True)), (by_band, room & first))
    ]
    return found[0].union(found[1]).distinct().join(met.select("a", "b"), ["a", "b"], "left_anti")


def _possible(percent: int):
    """Rows with one key, in different components, that size and sketch do not rule out as a link."""
    near = F.col("x.n_shingles"), F.col("y.n_shingles")
    differ = F.bit_count(F.col("x.s1").bitwiseXOR(F.col("y.s1"))) + F.bit_count(
        F.col("x.s2").bitwiseXOR(F.col("y.s2"))
    )
    return (
        (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id"))
        & (F.col("x.component") != F.col("y.component"))
        & (100 * F.least(*near) >= percent * F.greatest(*near))
        & (differ <= (_SKETCH_BITS if percent >= 85 else _SKETCH_BITS_BELOW_85))
    )


def drop_near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", percent: int = 85
) -> DataFrame:
    """One document of each component: the rows of the kept ids, with their columns.

    The list of dropped ids is written and counted first. Of rows that share an id
    the one with the smallest text stays.
    """
    dropped = stored(
        near_duplicates(df, id_col, text, percent).where("NOT kept").select(id_col).distinct(), "dropped"
    )
    kept = picked(df, dropped, id_col, "left_anti")
    if not _repeats(df.select(F.col(id_col).alias("id")).where("id IS NOT NULL")):
        return kept
    columns = F.struct(*[F.col(c) for c in df.columns])
    first = kept.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.min_by(columns, F.struct(F.col(text), F.to_json(columns))).alias("_row")
    )
    return first.select("_row.*").unionByName(kept.where(F.col(id_col).isNull()))
