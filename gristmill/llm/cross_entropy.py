"""Language-model scoring by cross-entropy difference.

Two interpolated word bigram models, one of the target documents and one of all
documents (the background), share one vocabulary, one smoothing and one size: the
background counts are scaled to the target's number of words. A document's score
is the mean over its words of background loss minus target loss, in bits, so more
is more like the target.

Every word and every word pair that occurs has an entry of its own, at every size
of the corpus; nothing is sampled, pruned or cut. The models stay distributed: no
table of words or pairs is collected or broadcast.

How the work is spread: a first pass counts the distinct words. Then texts are dealt
into chunks of about ``CHUNK_WORDS`` words by a hash of id and text. A chunk sends
its distinct words and pairs with their counts to buckets by hash, once each however
often they occur in it, so that a word or pair of every text reaches its bucket as
one entry per chunk. A bucket of about ``BUCKET_KEYS`` entries adds them up and sends
the sums back in the chunk's order, without the keys; the chunk then prices its texts.
Chunks and buckets grow in number with the corpus, not in size. Counts travel as packed
arrays, one row per chunk and bucket. Words and pairs are told apart by 64-bit hashes.

Defined results: a NULL or empty text has no words and all its numbers are 0; rows
that share an id are scored each; without target documents both models are the
background's and every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm import words as W
from gristmill.streaming.guards import require_batch

SHARE = 0.0  # of all words, for an entry of its own: every word and pair that occurs has one
PRIOR_PAIRS = 8.0  # how many pairs the single-word model is worth after each word
PRIOR_WORDS = 1.0  # how many words the uniform distribution is worth
CHUNK_WORDS = 1_500_000  # words whose texts are priced together, on average
BUCKET_KEYS = 1_000_000  # words and pairs added up together, on average
LEAST = 64  # chunks and buckets of a small table

_COUNTED_AT_ONCE = 4_000_000  # words a task counts before it sends the counts on
_COUNTS = "key bigint, n bigint, n_target bigint"
_START = np.uint64(2**64 - 1)  # stands before a text's first word; sorts behind all words
_PAIR = W.multipliers(2, 23)
_SENT = "chunk int, bucket int, words binary, word_counts binary, pairs binary, pair_counts binary"
_SUMS = "chunk int, bucket int, word_sums binary, pair_sums binary"


def _counted(codes: list[np.ndarray], target: list[np.ndarray]) -> pa.RecordBatch:
    every = np.concatenate(codes) if codes else np.empty(0, np.int64)
    flags = np.concatenate(target) if target else np.empty(0, bool)
    keys, at, n = np.unique(every, return_inverse=True, return_counts=True)
    hit = np.bincount(at[flags], minlength=len(keys))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(n.astype(np.int64)), pa.array(hit.astype(np.int64))], ["key", "n", "n_target"]
    )


def _count(texts: DataFrame) -> DataFrame:
    """Words (hashes) with their counts in all and in target texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, target, held = [], [], 0
        for batch in batches:
            flags = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
            for part in W.chunks(batch.column("text"), lower=True):
                codes.append(part.hashes().view(np.int64))
                target.append(np.repeat(flags[part.rows], part.counts))
                held += len(codes[-1])
                if held >= _COUNTED_AT_ONCE:
                    yield _counted(codes, target)
                    codes, target, held = [], [], 0
        yield _counted(codes, target)

    return texts.mapInArrow(run, _COUNTS).groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("n_target").alias("n_target")
    )


def _packed(values: np.ndarray) -> bytes:
    """An array byte by byte: first bytes of all rows, then second ones; like bytes compress well."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""


def _unpacked(data: bytes, kind: type, columns: int) -> np.ndarray:
    width = np.dtype(kind).itemsize * columns
    planes = np.frombuffer(bytearray(data), np.uint8).reshape(width, len(data) // width)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1, columns)


def _bucket_edges(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each bucket's part of sorted keys begins; buckets are ranges of keys."""
    bucket = (keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(n + 1, dtype=np.uint64))


@dataclass
class Coded:
    """The words of a chunk's texts as places in its sorted distinct words and pairs.

    The start is the last of the words. ``text_of`` has each word's text.
    """

    sizes: np.ndarray
    text_of: np.ndarray
    words: np.ndarray
    own: np.ndarray
    before: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray


def _coded(column: pa.ChunkedArray) -> Coded:
    parts = [p for array in column.chunks for p in W.chunks(array, lower=True)]
    hashes = np.concatenate([np.empty(0, np.uint64), *(p.hashes() for p in parts)])
    sizes = np.concatenate([np.empty(0, np.int64), *(p.counts for p in parts)]).astype(np.int64)
    words, own = np.unique(hashes, return_inverse=True)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    before, left = np.empty_like(own), np.empty_like(hashes)
    before[1:], left[1:] = own[:-1], hashes[:-1]
    before[first], left[first] = len(words), _START
    pairs, pair = np.unique(W.mix(left * _PAIR[0] + hashes * _PAIR[1]), return_inverse=True)
    return Coded(sizes, np.repeat(np.arange(len(sizes)), sizes), np.append(words, _START), own, before, pairs, pair)


def _send(buckets: int):
    """A chunk's words with their counts and how often they are followed, and its pairs, by bucket."""
    def run(table: pa.Table) -> pa.Table:
        coded = _coded(table["text"])
        hit = np.asarray(table["target"].to_numpy(), bool)[coded.text_of]

        def counts(at: np.ndarray, n: int) -> list[np.ndarray]:
            return [np.bincount(at, minlength=n), np.bincount(at[hit], minlength=n)]

        n = len(coded.words)
        kinds = (
            (coded.words, np.column_stack(counts(coded.own, n) + counts(coded.before, n)).astype(np.uint32)),
            (coded.pairs, np.column_stack(counts(coded.pair, len(coded.pairs))).astype(np.uint32)),
        )
        edges = [_bucket_edges(keys, buckets) for keys, _ in kinds]
        used = [b for b in range(buckets) if any(e[b] < e[b + 1] for e in edges)]
        sent = [
            [_packed(values[e[b]:e[b + 1]]) for b in used] for e, kind in zip(edges, kinds) for values in kind
        ]
        chunk = table["chunk"][0].as_py()
        return pa.table([
            pa.array([chunk] * len(used), pa.int32()), pa.array(used, pa.int32()),
            *(pa.array(column, pa.binary()) for column in sent),
        ], ["chunk", "bucket", "words", "word_counts", "pairs", "pair_counts"])

    return run


def _add(table: pa.Table) -> pa.Table:
    """A bucket's sums, for each chunk in the order of the keys it sent."""
    answers = []
    for name, columns in (("word", 4), ("pair", 2)):
        sent = [_unpacked(k, np.uint64, 1)[:, 0] for k in table[f"{name}s"].to_pylist()]
        counts = np.concatenate([_unpacked(c, np.uint32, columns) for c in table[f"{name}_counts"].to_pylist()])
        keys, at = np.unique(np.concatenate(sent), return_inverse=True)
        sums = np.column_stack([
            np.bincount(at, weights=counts[:, k], minlength=len(keys)).astype(np.int64) for k in range(columns)
        ])
        edges = np.cumsum([0, *map(len, sent)])
        answers.append(pa.array([_packed(sums[at[lo:hi]]) for lo, hi in zip(edges, edges[1:])], pa.binary()))
    return pa.table([table["chunk"], table["bucket"], *answers], ["chunk", "bucket", "word_sums", "pair_sums"])


def _price(total: int, targets: int, distinct: int):
    """Losses of a chunk's texts from the sums of its words and pairs."""
    # which column of the sums, and what counts are multiplied with to be of the target's size
    models = ((1, 1.0), (0, targets / total)) if targets else ((0, 1.0), (0, 1.0))
    size = targets or total

    def run(texts: pa.Table, sums: pa.Table) -> pa.Table:
        coded = _coded(texts["text"])
        sums = sums.sort_by("bucket")
        of_words, of_pairs = (
            np.concatenate([np.empty((0, k), np.int64), *(_unpacked(b, np.int64, k) for b in sums[name].to_pylist())])
            for name, k in (("word_sums", 4), ("pair_sums", 2))
        )
        if (len(of_words), len(of_pairs)) != (len(coded.words), len(coded.pairs)):
            raise ValueError("sums do not belong to these texts")
        losses = []
        for m, scale in models:
            single = (of_words[:, m] * scale + PRIOR_WORDS / (distinct + 1)) / (size + PRIOR_WORDS)
            after = of_words[:, 2 + m] * scale
            loss = -np.log2(
                (of_pairs[coded.pair, m] * scale + PRIOR_PAIRS * single[coded.own])
                / (after[coded.before] + PRIOR_PAIRS)
            )
            summed = np.bincount(coded.text_of, weights=loss, minlength=len(coded.sizes))
            losses.append(summed / np.maximum(coded.sizes, 1))
        return pa.table([
            texts["_id"], pa.array(coded.sizes), pa.array(losses[0]), pa.array(losses[1]),
            pa.array(losses[1] - losses[0]),
        ], ["_id", "n_words", "target_loss", "background_loss", "score"])

    return run


def cross_entropy_difference(df: DataFrame, is_target, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_words, target_loss, background_loss, score)`` per row; losses are bits per word.

    Both models are fitted on ``df``; ``is_target`` is a condition on its rows.
    """
    require_batch(df, "cross_entropy_difference")
    rows = df.select(
        F.col(id_col).alias("_id"), F.col(text).alias("text"), F.coalesce(is_target, F.lit(False)).alias("target")
    )
    total, targets, distinct = _count(rows.select("text", "target")).agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("n_target"), F.lit(0)), F.count(F.lit(1))
    ).first()
    chunks, buckets = max(total // CHUNK_WORDS, LEAST), max(total // BUCKET_KEYS, LEAST)
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("_id", "text"), F.lit(chunks)).cast("int"))
    sums = dealt.groupBy("chunk").applyInArrow(_send(buckets), _SENT).groupBy("bucket").applyInArrow(_add, _SUMS)
    kind = rows.schema["_id"].dataType.simpleString()
    return dealt.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(
        _price(total, targets, distinct),
        f"_id {kind}, n_words bigint, target_loss double, background_loss double, score double",
    ).withColumnRenamed("_id", id_col)
