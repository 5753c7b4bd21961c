"""Line dedup by two Bloom filters: once-seen and twice-seen line keys.

A text is split at ``\\n`` (a NULL or empty text is one empty line). A line's key
is the line with ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased.
Keys of at least ``min_chars`` code points that occur in at least ``min_docs``
documents (distinct ``doc_id``) lose all their lines, except in the largest
``doc_id`` holding them. Other lines stay, joined by ``\\n``.

How it runs:

1. Each task hashes the distinct long keys of its rows (xxhash64) into a pair of
   bit arrays: a key seen for the first time goes into *once*, a key already in
   *once* into *twice*. The pair is cut into chunks.
2. Pairs merge by chunk in two levels of a tree: ``twice = twice | twice' |
   (once & once')``, ``once = once | once'``. The merged *twice* filter is sent
   to every executor; its size is bounded by ``MAX_BITS``.
3. A second pass over the texts keeps only the long lines whose key hits *twice*:
   the suspected repeats. Only they are shuffled, by their whole key, where
   distinct documents are counted exactly and the keeper is chosen.

A key in two or more documents always hits *twice*; a false positive only adds
a suspect that exact counting then clears, so results do not depend on the
filter's size, only the shuffle does.

Defined results: a NULL ``doc_id`` is no document for the count and never a
keeper, so its lines with a frequent key are dropped; rows repeated with the
same ``doc_id`` count as one document and are treated alike; a NULL text stays
NULL (one empty line, nothing dropped); an empty table gives no rows. The
result has the input's columns in their order with the text replaced, and a
struct ``line_dedup`` (``n_lines``, ``n_dropped``); an input column of that name is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.components import BROADCAST_IDS, stored

MIN_CHARS = 40
MIN_DOCS = 5
BITS_PER_KEY = 16  # fewer than one key in a thousand is a false suspect at this load
PROBES = 4
LEAST_BITS = 1 << 16
MAX_BITS = 1 << 27  # 16 MB a filter: what each executor receives, at most
CHUNK_BITS = 1 << 19  # 64 KB of each filter per merged row
FAN = 32  # first level of the merge: so many groups of tasks per chunk
BROADCAST_BYTES = 64 << 20  # keys to drop, sent to every executor if they take no more; joined by shuffle beyond

_BLANKS = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """Blanks stripped at both ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _long_keys(text: Column, min_chars: int) -> Column:
    """The distinct keys of at least ``min_chars`` code points of a text, as an array."""
    keys = F.transform(_lines(text), line_key)
    return F.array_distinct(F.filter(keys, lambda k: F.length(k) >= min_chars))


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``PROBES`` bit positions per hash, by double hashing: shape (n, PROBES)."""
    h = hashes.astype(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)
    return ((low[:, None] + steps[None, :] * high[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _all_set(packed: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return ((packed[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1).astype(bool).all(axis=1)


def _set(packed: np.ndarray, pos: np.ndarray) -> None:
    flat = pos.ravel()
    np.bitwise_or.at(packed, flat >> 3, (np.uint8(1) << (flat & 7).astype(np.uint8)))


def _partial_filters(bits: int):
    """Per task: the (once, twice) pair over the key hashes of its rows, by chunk."""
    chunk_bytes = min(CHUNK_BITS, bits) // 8

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            flat = batch.column("hashes").flatten().to_numpy(zero_copy_only=False)
            if not len(flat):
                continue
            values, counts = np.unique(flat, return_counts=True)
            pos = _positions(values, bits)
            again = (counts > 1) | _all_set(once, pos)
            _set(twice, pos[again])
            _set(once, pos)
        chunks = [k for k in range(len(once) // chunk_bytes) if once[k * chunk_bytes:(k + 1) * chunk_bytes].any()]
        yield pa.RecordBatch.from_pydict({
            "chunk": pa.array(chunks, pa.int64()),
            "once": pa.array([once[k * chunk_bytes:(k + 1) * chunk_bytes].tobytes() for k in chunks], pa.binary()),
            "twice": pa.array([twice[k * chunk_bytes:(k + 1) * chunk_bytes].tobytes() for k in chunks], pa.binary()),
        })

    return build


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """One (once, twice) pair from several of the same chunk."""
    once = twice = None
    for a, b in zip(group["once"], group["twice"]):
        a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        if once is None:
            once, twice = a.copy(), b.copy()
        else:
            twice |= b | (once & a)
            once |= a
    return pd.DataFrame({"chunk": [group["chunk"].iloc[0]], "once": [once.tobytes()], "twice": [twice.tobytes()]})


_PAIR = "chunk long, once binary, twice binary"


def twice_filter(keyed: DataFrame, bits: int) -> np.ndarray:
    """The merged *twice* filter, packed, of the ``hashes`` arrays of ``keyed``."""
    parts = keyed.select("hashes").mapInArrow(_partial_filters(bits), _PAIR)
    fanned = parts.withColumn("_fan", F.pmod(F.spark_partition_id(), F.lit(FAN)))
    level = fanned.groupBy("chunk", "_fan").applyInPandas(_merge, _PAIR)
    merged = level.groupBy("chunk").applyInPandas(_merge, _PAIR).select("chunk", "twice").collect()
    out = np.zeros(bits // 8, np.uint8)
    size = min(CHUNK_BITS, bits) // 8
    for row in merged:
        out[row.chunk * size:(row.chunk + 1) * size] = np.frombuffer(row.twice, np.uint8)
    return out


def filter_bits(n_keys: int) -> int:
    """A power of two: ``BITS_PER_KEY`` a key, within ``LEAST_BITS`` and ``MAX_BITS``."""
    want = max(LEAST_BITS, BITS_PER_KEY * max(n_keys, 1))
    return min(MAX_BITS, 1 << (want - 1).bit_length())


def _suspects(twice, bits: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = twice.value
        for batch in batches:
            lengths = pc.fill_null(pc.list_value_length(batch.column("hashes")), 0).to_numpy(zero_copy_only=False)
            flat = batch.column("hashes").flatten().to_numpy(zero_copy_only=False)
            if not len(flat):
                continue
            hit = _all_set(packed, _positions(flat, bits))
            rows = np.repeat(np.arange(batch.num_rows), lengths)[hit]
            keys = batch.column("keys").flatten().filter(pa.array(hit))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows)), keys], ["doc_id", "key"]
            )

    return probe


def frequent_lines(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """``(doc_id, dropped)``: per document, the keys whose lines it loses (an array)."""
    keys = _long_keys(F.col(text_col), min_chars)
    keyed = stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), keys.alias("keys"),
        F.transform(keys, lambda k: F.xxhash64(k)).alias("hashes"),
    ).where(F.size("keys") > 0), "line-keys")
    n_keys = keyed.agg(F.sum(F.size("keys"))).first()[0] or 0
    if not n_keys:
        return docs.sparkSession.createDataFrame([], "doc_id long, dropped array<string>")
    bits = filter_bits(n_keys)
    twice = docs.sparkSession.sparkContext.broadcast(twice_filter(keyed, bits))
    suspects = stored(keyed.mapInArrow(_suspects(twice, bits), "doc_id long, key string"), "line-suspects")
    frequent = suspects.groupBy("key").agg(
        F.count_distinct("doc_id").alias("n_docs"), F.max("doc_id").alias("keeper")
    ).where(F.col("n_docs") >= min_docs).drop("n_docs")
    lost = suspects.join(frequent, "key").where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return stored(lost.groupBy("doc_id").agg(F.collect_set("key").alias("dropped")), "line-drops")


def drop_frequent_lines(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """The documents with their frequent lines removed; see the module's notes."""
    dropped = frequent_lines(docs, text_col, id_col, min_chars, min_docs).select(
        F.col("doc_id").alias("_lost_id"), F.col("dropped").alias("_lost")
    )
    rows, size = dropped.agg(
        F.count(F.lit(1)), F.sum(F.aggregate("_lost", F.lit(0).cast("long"), lambda n, k: n + F.octet_length(k) + 16))
    ).first()
    if rows <= BROADCAST_IDS and (size or 0) <= BROADCAST_BYTES:
        dropped = F.broadcast(dropped)
    names = [c for c in docs.columns if c != "line_dedup"]
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                      F.col(f"`{id_col}`").cast("long").alias("_id"))
    joined = row.join(dropped, F.col("_id").eqNullSafe(F.col("_lost_id")), "left")
    text = F.col(f"_row.`{text_col}`")
    lines = _lines(text)
    kept = F.filter(lines, lambda l: ~F.array_contains(F.col("_lost"), line_key(l)))
    whole = F.coalesce(text, F.lit(""))
    n_lines = (F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1).cast("long")
    # rows that lose no line are not split
    out = joined.select(
        "_row", F.when(text.isNull() | F.col("_lost").isNull(), text).otherwise(F.array_join(kept, "\n")).alias("_kept"),
        F.struct(n_lines.alias("n_lines"), F.when(F.col("_lost").isNull(), F.lit(0)).otherwise(
            n_lines - F.size(kept)).cast("long").alias("n_dropped")).alias("line_dedup"),
    )
    return out.select(
        *[(F.col("_kept") if c == text_col else F.col("_row").getField(c)).alias(c) for c in names], "line_dedup"
    )
