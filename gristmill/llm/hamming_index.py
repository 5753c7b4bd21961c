"""Approximate nearest neighbours by multi-index hashing.

Binary codes of 192 bits are learned on a bounded sample: principal axes, then
three rotations, each turned until its signs lose least (iterative quantisation).
Codes are split into sixteen substrings of twelve bits, and every partition of
the table indexes all its rows by each substring. For a query and a Hamming radius
``r = 16 s + a`` some substring of a code within the radius differs from the
query's by at most ``s`` (the first ``a + 1`` substrings) or ``s - 1`` bits (the
others), so probing the substring values that close finds every code within the
radius. The found codes are compared in full, and those within the radius are
ranked by Euclidean distance of the original vectors in double precision.

The radius is each query's own: the one that holds about ``candidates`` rows of
the table, estimated on the sample. A query left with fewer than ``k`` neighbours
is searched again with an unlimited radius.

How the work is spread: the table is read in place and not shuffled; queries are
sent to its partitions in blocks of bounded size, one pass per block; a partition
returns at most ``k`` rows per query.

Defined results: vectors that are NULL, zero, hold NULL or a non-finite number, or
have not the most frequent length take no part, nor do rows without id; rows that
share an id are candidates each, but one query (its smallest vector), and never
candidates of their own id; equal distances are ranked by id; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.components import hash_sample
from gristmill.sources.scratch import fresh_path
from gristmill.streaming.guards import require_batch

SAMPLE_ROWS = 20_000
ROTATIONS = 3
SUBSTRINGS = 16
CANDIDATES = 1_500
QUERY_BLOCK = 1_024

_RESULT = "query_id bigint, vec_id bigint, score double"


def usable_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, v)`` of the rows that take part; ``v`` holds doubles."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["n"] if sizes else 0))


class RotatedCodes:
    """Signs of the principal coordinates under learned rotations."""

    def __init__(self, sample: np.ndarray, rotations: int = ROTATIONS, rounds: int = 30) -> None:
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        axes = np.linalg.svd(centred, full_matrices=False)[2].T if len(sample) > 1 else np.eye(sample.shape[1])
        if axes.shape[1] < sample.shape[1]:
            axes = np.linalg.qr(np.column_stack([axes, np.eye(sample.shape[1])]))[0][:, :sample.shape[1]]
        coordinates, turned = centred @ axes, []
        for seed in range(rotations):
            turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))[0]
            for _ in range(rounds):
                signs = np.where(coordinates @ turn > 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(signs.T @ coordinates)
                turn = (left @ right).T
            turned.append(axes @ turn)
        self.turn = np.column_stack(turned)
        bits = self.turn.shape[1]
        self.width = -(-bits // SUBSTRINGS)  # bits per substring; the last ones may be padded with 0
        self.bits = bits

    def substrings(self, vectors: np.ndarray) -> np.ndarray:
        """The code of each vector as ``SUBSTRINGS`` small numbers."""
        bits = (vectors - self.mean) @ self.turn > 0
        padded = np.zeros((len(vectors), SUBSTRINGS * self.width), np.int64)
        padded[:, :self.bits] = bits
        powers = 1 << np.arange(self.width)
        return (padded.reshape(len(vectors), SUBSTRINGS, self.width) * powers).sum(axis=2).astype(np.int32)


class MultiIndex:
    """The codes of some rows, indexed by each substring."""

    def __init__(self, codes: np.ndarray, width: int) -> None:
        self.codes = codes
        self.ones = np.array([v.bit_count() for v in range(1 << width)], np.uint8)
        self.values = np.arange(1 << width)
        self.tables = []
        for j in range(SUBSTRINGS):
            order = np.argsort(codes[:, j], kind="stable")
            self.tables.append((order, np.searchsorted(codes[order, j], np.arange((1 << width) + 1))))

    def distances(self, code: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.ones[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code differs in at most ``radius`` bits."""
        most, extra = divmod(radius, SUBSTRINGS)
        found = np.zeros(len(self.codes), bool)
        for j, (order, edges) in enumerate(self.tables):
            near = most if j <= extra else most - 1
            if near < 0:
                continue
            hit = np.flatnonzero(self.ones[self.values ^ int(code[j])] <= near)
            lo, n = edges[hit], edges[hit + 1] - edges[hit]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            found[order[at]] = True
        rows = np.flatnonzero(found)
        return rows[self.distances(code, rows) <= radius]


def _radius(index: MultiIndex, code: np.ndarray, share: float, bits: int) -> int:
    """The radius that holds this share of the sample, and no fewer than 20 of its rows."""
    wanted = max(int(np.ceil(share * len(index.codes))), 20)
    if wanted >= len(index.codes):
        return bits
    distances = index.distances(code, np.arange(len(index.codes)))
    return int(np.partition(distances, wanted - 1)[wanted - 1])


def _search(
    rows: DataFrame, codes: RotatedCodes, ids: np.ndarray, vectors: np.ndarray, radii: np.ndarray, k: int
) -> DataFrame:
    """The ``k`` nearest rows per partition and query, of those within the radius."""
    query_codes = codes.substrings(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty(0, np.int64))] * len(ids)
        for batch in batches:
            own = batch.column("id").to_numpy()
            flat = batch.column("v").flatten().to_numpy()
            table = flat.reshape(len(own), -1)
            index = MultiIndex(codes.substrings(table), codes.width)
            for q in range(len(ids)):
                at = index.within(query_codes[q], int(radii[q]))
                at = at[own[at] != ids[q]]
                if len(at):
                    score = np.sqrt(((table[at] - vectors[q]) ** 2).sum(axis=1))
                    score, names = np.concatenate((best[q][0], score)), np.concatenate((best[q][1], own[at]))
                    order = np.lexsort((names, score))[:k]
                    best[q] = score[order], names[order]
        for q, (score, names) in enumerate(best):
            if len(names):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(names), ids[q])), pa.array(names), pa.array(score),
                ], ["query_id", "vec_id", "score"])

    near = rows.mapInArrow(run, _RESULT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k)


def nearest(
    df: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector: str = "embedding",
    candidates: int = CANDIDATES, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest rows found for each query row.

    ``is_query`` is a condition on the column ``id``. At most ``sample_rows`` rows,
    chosen by a hash of their id, are fitted on; every row is indexed.
    """
    require_batch(df, "nearest")
    spark = df.sparkSession
    rows = usable_vectors(df, id_col, vector)
    sampled = hash_sample(rows, sample_rows, "id").toPandas()
    path = fresh_path(spark, "neighbours")
    spark.createDataFrame([], f"{_RESULT}, rank int").write.parquet(path)
    if len(sampled):
        sample = np.array(sampled["v"].tolist())
        codes = RotatedCodes(sample)
        known = MultiIndex(codes.substrings(sample), codes.width)
        total = rows.count()
        queries = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
        blocks = -(-queries.count() // QUERY_BLOCK)
        for block in range(blocks):
            part = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toPandas()
            _run_block(rows, codes, known, part, candidates / total, k, total, path)
    found = spark.read.schema(f"{_RESULT}, rank int").parquet(path)
    return found.select("query_id", "rank", "vec_id", "score")


def _run_block(
    rows: DataFrame, codes: RotatedCodes, known: MultiIndex, part: pd.DataFrame, share: float, k: int,
    total: int, path: str,
) -> None:
    """Searches a block of queries and appends their neighbours; repeats it widely for short ones."""
    if not len(part):
        return
    ids, vectors = part["id"].to_numpy(), np.array(part["v"].tolist())
    radii = np.array([_radius(known, c, share, codes.bits) for c in codes.substrings(vectors)])
    spark = rows.sparkSession
    own = fresh_path(spark, "block")
    _search(rows, codes, ids, vectors, radii, k).write.parquet(own)
    found = spark.read.parquet(own)
    counts = dict(found.groupBy("query_id").count().toPandas().itertuples(index=False))
    few = np.array([counts.get(int(i), 0) < min(k, total - 1) and r < codes.bits for i, r in zip(ids, radii)])
    if few.any():
        again = ids[few].tolist()
        wide = _search(rows, codes, ids[few], vectors[few], np.full(few.sum(), codes.bits), k)
        found = found.where(~F.col("query_id").isin(again)).unionByName(wide)
    found.write.mode("append").parquet(path)
