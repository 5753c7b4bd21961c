"""Near-duplicates by MinHash signatures and banding.

A row is dropped iff it shares a band with a row of lower id. That closed form
equals the sequential rule "walk the rows in order, group each unseen row with
all rows it collides with, keep the lowest of each group", and needs neither
pairs nor connected components: two aggregations with map-side combine.
"""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.text import _col, words
from gristmill.operators.dedup import keep_ids
from gristmill.sources.scratch import checkpointed, fresh_path
from gristmill.streaming.guards import require_batch


def permutations(num_perm: int = fixed.NUM_PERM, seed: int = 1) -> list[tuple[int, int]]:
    """(a, b) of h -> (h*a + b) mod (2^31 - 1); with 28-bit h the product stays below 2^59+."""
    rng = random.Random(seed)
    return [
        (rng.randrange(1, fixed.MERSENNE_31), rng.randrange(0, fixed.MERSENNE_31))
        for _ in range(num_perm)
    ]


def _word_hash(w: Column) -> Column:
    return F.conv(F.substring(F.md5(w.cast("binary")), 1, 7), 16, 10).cast("int")


def word_hashes(text: Column | str) -> Column:
    """Distinct lower-cased words as 28-bit integers; null text counts as the word "none"."""
    return F.transform(
        F.array_distinct(words(F.lower(F.coalesce(_col(text), F.lit("None"))))), _word_hash
    )


def _signature_udf(num_perm: int, seed: int):
    # plain values only: the function travels to workers that may not have this package
    coefficients = permutations(num_perm, seed)
    prime = fixed.MERSENNE_31
    rows_per_step = 256  # bounds the temporaries, whatever the Arrow batch holds

    @F.pandas_udf("array<int>")
    def signature(hashes: pd.Series) -> pd.Series:
        out = []
        for start in range(0, len(hashes), rows_per_step):
            part = hashes.iloc[start:start + rows_per_step].to_numpy()
            sizes = np.fromiter((len(h) for h in part), dtype=np.int64, count=len(part))
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            flat = np.concatenate(part).astype(np.int64)
            mins = np.empty((len(part), num_perm), dtype=np.int32)
            for i, (a, b) in enumerate(coefficients):
                mins[:, i] = np.minimum.reduceat((flat * a + b) % prime, starts)
            out.extend(mins)
        return pd.Series(out, dtype=object)

    return signature


def signature(
    text: Column | str, num_perm: int = fixed.NUM_PERM, seed: int = 1
) -> Column:
    """MinHash signature of the word set.

    Row-local, so no token is ever shuffled. The permutations run on NumPy over
    Arrow batches: Spark evaluates higher-order functions interpreted, which
    measured over three times slower for 128 permutations (README).
    """
    return _signature_udf(num_perm, seed)(word_hashes(text))


def band_keys(
    df: DataFrame, text: str, id_col: str = "row_id",
    num_perm: int = fixed.NUM_PERM, bands: int = fixed.BANDS, seed: int = 1,
) -> DataFrame:
    """(band_key, id): ``bands`` rows per text; the 16-byte key includes the band number."""
    if num_perm % bands:
        raise ValueError("num_perm must be a multiple of bands")
    size = num_perm // bands
    signed = df.select(F.col(id_col), signature(text, num_perm, seed).alias("_sig"))
    bands_sql = ", ".join(
        f"unhex(md5(concat('{b}:', array_join(cast(slice(_sig, {b * size + 1}, {size})"
        " as array<string>), ','))))"
        for b in range(bands)
    )
    keys = F.expr(f"array({bands_sql})")
    return signed.select(F.explode(keys).alias("band_key"), id_col)


def near_duplicate_kept_ids(
    df: DataFrame, text: str, id_col: str = "row_id",
    num_perm: int = fixed.NUM_PERM, bands: int = fixed.BANDS, seed: int = 1,
) -> DataFrame:
    """Ids that are the lowest in each of their bands, hence survive."""
    lowest = (
        band_keys(df, text, id_col, num_perm, bands, seed)
        .groupBy("band_key").agg(F.min(id_col).alias(id_col))
    )
    wins = lowest.groupBy(id_col).agg(F.count(F.lit(1)).alias("_wins"))
    return wins.where(F.col("_wins") == bands).select(id_col)


def drop_near_duplicates(
    df: DataFrame, text: str, id_col: str = "row_id",
    num_perm: int = fixed.NUM_PERM, bands: int = fixed.BANDS, seed: int = 1,
    store_drops: bool = False,
) -> DataFrame:
    """Rows without a near-duplicate of lower id; ``store_drops`` as in ``keep_ids``."""
    require_batch(df, "drop_near_duplicates")
    kept = near_duplicate_kept_ids(df, text, id_col, num_perm, bands, seed)
    return keep_ids(df, kept, id_col, store_drops)


def near_duplicate_drops(
    df: DataFrame, text: str, id_col: str = "row_id",
    num_perm: int = fixed.NUM_PERM, bands: int = fixed.BANDS, seed: int = 1,
) -> DataFrame:
    """Ids that ``drop_near_duplicates`` removes; reads no text a second time."""
    require_batch(df, "near_duplicate_drops")
    kept = near_duplicate_kept_ids(df, text, id_col, num_perm, bands, seed)
    return df.select(id_col).join(kept, id_col, "left_anti")


_HOT_BANDS = 1_000_000  # the most bands that can count as hot, see below


def near_duplicate_groups(
    df: DataFrame, text: str, id_col: str = "row_id",
    num_perm: int = fixed.NUM_PERM, bands: int = fixed.BANDS, seed: int = 1,
) -> DataFrame:
    """(leader_id, n_members): the groups the sequential rule reports."""
    require_batch(df, "near_duplicate_groups")
    bands_of = checkpointed(band_keys(df, text, id_col, num_perm, bands, seed))
    return groups_from_bands(bands_of, id_col)


def groups_from_bands(
    members: DataFrame, id_col: str = "row_id", hot_rows: int = 1_000_000
) -> DataFrame:
    """Groups from a stored (band_key, id) table.

    Leaders are found in rounds: an undecided row that is the lowest undecided
    one in all of its bands leads; rows sharing a band with a leader are then
    decided. Each band has at most one leader, so (leader, member) rows number
    at most one per row of ``members``. A round joins undecided rows only, is cut
    with a checkpoint in the shared folder, and appends its leaders to one stored
    table, so the plan does not grow with the rounds.

    Members of bands with more than ``hot_rows`` rows are joined salted by row
    id, with one salt per ``hot_rows`` rows of the band, so a band that holds a
    third of the corpus is spread over as many tasks as it needs. The threshold
    rises with the table, which keeps the list of hot bands below a fixed length
    and therefore fit to be broadcast.
    """
    spark = members.sparkSession
    hot_rows = max(hot_rows, members.count() // _HOT_BANDS)
    shared = checkpointed(
        members.groupBy("band_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    hot = F.broadcast(shared.where(F.col("n") > hot_rows).select(
        "band_key", F.ceil(F.col("n") / hot_rows).cast("int").alias("_salts")
    ))

    def one_salt(rows: DataFrame) -> DataFrame:
        salt = F.pmod(F.xxhash64(id_col), F.coalesce("_salts", F.lit(1)))
        return rows.join(hot, "band_key", "left").withColumn("_salt", salt.cast("int")).drop("_salts")

    def every_salt(keys: DataFrame) -> DataFrame:
        salt = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
        return keys.join(hot, "band_key", "left").withColumn("_salt", F.explode(salt)).drop("_salts")

    on_band = ["band_key", "_salt"]
    # rows colliding with nobody are in no group; drop them before the rounds
    colliding = checkpointed(
        one_salt(members).join(every_salt(shared.select("band_key")), on_band, "left_semi")
    )
    # a row's private bands play no part, so wins are counted against its shared bands
    n_bands = colliding.groupBy(id_col).agg(F.count(F.lit(1)).alias("_bands"))
    involved = checkpointed(colliding.join(n_bands, id_col))

    leaders, schema = fresh_path(spark, "leaders"), members.schema
    spark.createDataFrame([], schema).write.parquet(leaders)
    undecided = involved
    while not undecided.isEmpty():
        lowest = undecided.groupBy("band_key").agg(F.min(F.struct(id_col, "_bands")).alias("_row"))
        new = (
            lowest.groupBy(F.col(f"_row.{id_col}").alias(id_col), F.col("_row._bands").alias("_bands"))
            .agg(F.count(F.lit(1)).alias("_wins")).where("_wins = _bands").select(id_col)
        )
        led = checkpointed(undecided.join(new, id_col).select(*schema.names))
        led.write.mode("append").parquet(leaders)
        covered = undecided.join(every_salt(led.select("band_key")), on_band, "left_semi").select(id_col).distinct()
        undecided = checkpointed(undecided.join(covered, id_col, "left_anti"))
    found = spark.read.schema(schema).parquet(leaders).select("band_key", F.col(id_col).alias("leader_id"))
    pairs = involved.join(every_salt(found), on_band).select("leader_id", id_col).distinct()
    # two-step count: the distinct rows are spread by (leader, member)
    return pairs.groupBy("leader_id").agg(F.count(F.lit(1)).alias("n_members"))


def near_duplicate_summary(groups: DataFrame) -> DataFrame:
    """Number of groups and of row mentions in them."""
    return groups.agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.coalesce(F.sum("n_members"), F.lit(0)).alias("n_rows_involved"),
    )


def split_leaks(
    df: DataFrame, text: str, split: str = "split", id_col: str = "row_id",
    num_perm: int = fixed.NUM_PERM, bands: int = fixed.BANDS, seed: int = 1,
) -> DataFrame:
    """(split, other, n_bands, n_rows): near-copies that two splits share, by MinHash band.

    For each pair of splits, ``split`` is the rarer one (fewer rows; ties by
    name). ``n_bands`` counts band keys that rows of both hold; ``n_rows`` counts
    rows of ``split`` with a band key that a row of ``other`` holds too.

    Each band key is aggregated once, with the bitmap of the splits seen there
    (combined in each task, so a band held by a third of the rows moves one row
    per task); only band keys of more than one split are met again, and only by
    the rows of the rarer splits. Pairs without a shared band report zeros; a
    NULL split is a split of its own name, "".
    """
    require_batch(df, "split_leaks")
    named = df.select(id_col, text, F.coalesce(F.col(split).cast("string"), F.lit("")).alias("_split"))
    sizes = sorted((r["_split"], r["n"]) for r in named.groupBy("_split").agg(F.count(F.lit(1)).alias("n")).collect())
    if len(sizes) > 62:
        raise ValueError("split_leaks compares at most 62 splits")
    bit = {name: 1 << k for k, (name, _) in enumerate(sizes)}
    rank = {name: (n, name) for name, n in sizes}
    pairs = [
        (a, b) if rank[a] < rank[b] else (b, a)
        for k, (a, _) in enumerate(sizes) for b, _ in sizes[k + 1:]
    ]
    spark = df.sparkSession
    if not pairs:
        return spark.createDataFrame([], "split string, other string, n_bands long, n_rows long")
    who = named.select(F.struct(F.col(id_col).alias("id"), F.col("_split").alias("split")).alias("_who"), text)
    held = checkpointed(band_keys(who, text, "_who", num_perm, bands, seed)).withColumn(
        "_bit", F.element_at(F.create_map(*[F.lit(x) for kv in bit.items() for x in kv]), F.col("_who.split"))
    )
    seen = checkpointed(
        held.groupBy("band_key").agg(F.bit_or("_bit").alias("_seen")).where(F.bit_count("_seen") > 1)
    )
    masks = [(k, bit[a] | bit[b]) for k, (a, b) in enumerate(pairs)]
    pair_ids = F.filter(
        F.array(*[F.when(F.col("_seen").bitwiseAND(m) == m, F.lit(k)) for k, m in masks]), lambda x: x.isNotNull()
    )
    n_bands = seen.select(F.explode(pair_ids).alias("_pair")).groupBy("_pair").agg(
        F.count(F.lit(1)).alias("n_bands")
    )
    rare = sorted({a for a, _ in pairs})
    met = held.where(F.col("_who.split").isin(rare)).join(seen, "band_key").groupBy("_who").agg(
        F.bit_or("_seen").alias("_seen")
    )
    own = [(k, bit[a], bit[b]) for k, (a, b) in enumerate(pairs)]
    row_pairs = F.filter(
        F.array(*[
            F.when((F.col("_who.split") == a) & (F.col("_seen").bitwiseAND(ob) != 0), F.lit(k))
            for k, (a, _), (_, _, ob) in zip(range(len(pairs)), pairs, own)
        ]),
        lambda x: x.isNotNull(),
    )
    n_rows = met.select(F.explode(row_pairs).alias("_pair")).groupBy("_pair").agg(F.count(F.lit(1)).alias("n_rows"))
    listed = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "_pair int, split string, other string")
    return listed.join(n_bands, "_pair", "left").join(n_rows, "_pair", "left").select(
        "split", "other", F.coalesce("n_bands", F.lit(0)).cast("long").alias("n_bands"),
        F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"),
    )


def index_bands(
    df: DataFrame, text: str, table: str, id_col: str = "row_id", buckets: int | None = None,
    num_perm: int = fixed.NUM_PERM, bands: int = fixed.BANDS, seed: int = 1,
) -> DataFrame:
    """Inserts the rows' band keys into ``table``, a warehouse table bucketed by band key, created if absent.

    Only the new rows' texts are read; what the table holds is one narrow row
    (band key, id) per band of every row inserted so far. Returns the table.
    """
    require_batch(df, "index_bands")
    spark = df.sparkSession
    keys = band_keys(df, text, id_col, num_perm, bands, seed)
    if spark.catalog.tableExists(table):
        keys.write.mode("append").insertInto(table)
    else:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        keys.write.bucketBy(buckets, "band_key").sortBy("band_key").saveAsTable(table)
    return spark.table(table)


def query_index(
    df: DataFrame, text: str, table: str, id_col: str = "row_id",
    num_perm: int = fixed.NUM_PERM, bands: int = fixed.BANDS, seed: int = 1,
) -> DataFrame:
    """(id, lowest_id): rows of ``df`` that share a band with a lower id already in the index, and the lowest such id.

    The indexed side is read bucketed by band key, so only the queried rows' keys move.
    """
    spark = df.sparkSession
    keys = band_keys(df, text, id_col, num_perm, bands, seed)
    indexed = spark.table(table).groupBy("band_key").agg(F.min(id_col).alias("_lowest"))
    hits = keys.join(indexed, "band_key").where(F.col("_lowest") < F.col(id_col))
    return hits.groupBy(id_col).agg(F.min("_lowest").alias("lowest_id"))


def indexed_drops(spark, table: str, id_col: str = "row_id", bands: int = fixed.BANDS) -> DataFrame:
    """Ids of the index that ``drop_near_duplicates`` over all inserted rows would remove.

    The minimum per band key is taken on the bucketed table without an exchange.
    """
    members = spark.table(table)
    lowest = members.groupBy("band_key").agg(F.min(id_col).alias(id_col))
    wins = lowest.groupBy(id_col).agg(F.count(F.lit(1)).alias("_wins")).where(F.col("_wins") == bands)
    return members.select(id_col).distinct().join(wins.select(id_col), id_col, "left_anti")
