"""Token ids in flat binary files with 64-bit document offsets.

A folder of token files holds, per partition ``k`` of the ascending id order,

    NNNNN.u2       token ids as unsigned 16-bit integers, little endian, nothing
                   else; NNNNN.u4 with 32 bits if the vocabulary needs them
    NNNNN.offsets  signed 64-bit ends: entry i is where document i starts, counted
                   over the whole folder; one more entry closes the last document
    NNNNN.docs     signed 64-bit document ids

The first pass range-partitions by id, encodes, and writes ids and document ids.
Each task returns one row per document count and token count; prefix sums over
these (one row per partition) give every partition's base, and the second pass
writes the offsets with the base added. Files are memory-mapped for reading. Every
file is written under a name of its own and moved into place, so a task that is
run again leaves the same files.

Defined results: a NULL or empty text is the end id alone; rows that share an id
follow one another in the order of their texts; a NULL id comes first and is
written as the smallest 64-bit number; an empty table gives a folder without files.
"""

from __future__ import annotations

import os
import sys
import uuid
import zlib
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.llm import words as W
from gristmill.llm.components import stored
from gristmill.streaming.guards import require_batch

END_ID = 1
CACHED_PIECES = 1_000_000  # distinct words whose ids a Python worker remembers

_TAIL = W.byte_table(b".,;:!?)|&$%#*\"")  # punctuation that is parted from what stands before it
_PLAIN = W.byte_table(bytes(range(48, 58)) + bytes(range(97, 123)) + bytes(range(65, 91)))
_LOWER = W.LOWER
NULL_ID = np.iinfo(np.int64).min


class WordEncoder:
    """Encodes texts word by word, each distinct word once.

    For tokenizers that fold case, never join or look across ASCII whitespace, and
    part letters and digits from punctuation behind them: the ids of a text are then
    those of its words, and those of a word the ids of its core and of its tail of
    punctuation. ``check_splits`` compares with encoding whole texts. Cores and
    tails are told apart by 64-bit hashes; what is known is kept for the life of the
    Python worker, up to ``CACHED_PIECES``, then forgotten.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark deals out the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.n_ids = max(vocabulary.values()) + 1
        self.closes = np.zeros(self.n_ids, bool)  # ids that end a run of letters
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._clear()

    @classmethod
    def of_worker(cls, path: str) -> WordEncoder:
        """The encoder of this Python worker, shared by the tasks it runs."""
        kept = sys.modules.setdefault("_word_encoders", ModuleType("_word_encoders")).__dict__
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def _clear(self) -> None:
        self.hashes, self.pieces = np.empty(0, np.uint64), np.empty(0, np.int64)
        # piece 0 is the empty tail
        self.flat, self.starts, self.sizes = np.empty(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The piece numbers of byte spans; new ones are encoded."""
        hashes = W.span_hashes(data, starts, ends)
        new, at = np.unique(hashes, return_index=True)
        fresh = ~np.isin(new, self.hashes, assume_unique=True)
        if len(self.hashes) + fresh.sum() > CACHED_PIECES and len(self.hashes):
            self._clear()
            fresh[:] = True
        new, at = new[fresh], at[fresh]
        if len(new):
            raw = data.tobytes()
            ids = self._encode_pieces([raw[starts[k]:ends[k]].decode() for k in at.tolist()])
            sizes = np.array([len(i) for i in ids], np.int64)
            numbers = len(self.sizes) + np.arange(len(new))
            self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(sizes) - sizes))
            self.sizes = np.concatenate((self.sizes, sizes))
            self.flat = np.concatenate((self.flat, *ids)).astype(np.uint32)
            merged = np.concatenate((self.hashes, new))
            order = np.argsort(merged, kind="stable")
            self.hashes = merged[order]
            self.pieces = np.concatenate((self.pieces, numbers))[order]
        return self.pieces[np.searchsorted(self.hashes, hashes)]

    def _encode_pieces(self, pieces: list[str]) -> list[np.ndarray]:
        """The ids of each piece; runs of letters are encoded many at a time and cut at closing ids."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        letters = [k for k, piece in enumerate(pieces) if piece.isalpha()]
        for at in range(0, len(letters), 512):
            own = letters[at:at + 512]
            ids = np.array(self._ids([" ".join([pieces[k] for k in own])])[0], np.uint32)
            ends = (np.flatnonzero(self.closes[ids]) + 1).tolist()
            if len(ends) == len(own):
                for k, lo, hi in zip(own, [0, *ends], ends):
                    out[k] = ids[lo:hi]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for at in range(0, len(rest), 4096):
            own = rest[at:at + 4096]
            for k, ids in zip(own, self._ids([pieces[k] for k in own])):
                out[k] = np.array(ids, np.uint32)
        return out

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, part: W.Words, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk's texts, each text closed by ``end_id``, and the ids per text."""
        starts, ends = part.starts, part.ends
        data = _LOWER[part.data]
        special = np.flatnonzero((part.data[:-1] == ord("<")) & (part.data[1:] == ord("|")))
        for k in np.unique(np.searchsorted(starts, special, "right") - 1).tolist():
            data[starts[k]:ends[k]] = part.data[starts[k]:ends[k]]  # a special token's case counts
        cores = ends.copy()
        while len(more := np.flatnonzero(_TAIL[data[cores - 1]] & (cores - starts > 1))):
            cores[more] -= 1
        cores = np.where(_PLAIN[data[cores - 1]] if len(cores) else False, cores, ends)
        pieces = np.zeros((len(starts), 2), np.int64)
        tails = np.flatnonzero(cores < ends)
        spans = np.concatenate((starts, cores[tails])), np.concatenate((cores, ends[tails]))
        order = np.argsort(spans[0], kind="stable")
        numbers = np.empty(len(order), np.int64)
        numbers[order] = self._numbers(data, spans[0][order], spans[1][order])
        pieces[:, 0], pieces[tails, 1] = numbers[:len(starts)], numbers[len(starts):]
        at = pieces.ravel()
        sizes = self.sizes[at]
        before = np.concatenate(([0], np.cumsum(sizes)))
        edges = 2 * part.bounds
        own = before[edges[1:]] - before[edges[:-1]]
        counts = own + 1
        ids = np.full(int(counts.sum()), end_id, np.uint32)
        place = np.arange(before[-1]) + np.repeat(np.arange(len(own)), own)
        ids[place] = self.flat[np.arange(before[-1]) - np.repeat(before[:-1] - self.starts[at], sizes)]
        return ids, counts


def check_splits(path: str, texts: list[str]) -> bool:
    """Whether encoding word by word gives the ids of encoding whole texts."""
    encoder = WordEncoder(path)
    found = [encoder.encode(part, END_ID) for part in W.chunks(pa.array(texts, pa.large_string()))]
    ids, counts = (np.concatenate(c) for c in zip(*found))
    whole = [e.ids + [END_ID] for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    return counts.tolist() == [len(w) for w in whole] and ids.tolist() == [i for w in whole for i in w]


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system and path behind a folder's address."""
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder
    )


def _put(files: fs.FileSystem, path: str, parts: Iterator[np.ndarray]) -> None:
    own = f"{path}.{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        for part in parts:
            out.write(np.ascontiguousarray(part))
    files.move(own, path)


def _mapped(folder: str, name: str, kind: type) -> np.ndarray:
    """A file's numbers: memory-mapped on a local or mounted path, else read."""
    files, root = _place(folder)
    path = f"{root}/{name}"
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.empty(0, kind)
    with files.open_input_file(path) as source:
        return np.frombuffer(source.readall(), kind)


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text: str = "text",
    end_id: int = END_ID, partitions: int | None = None,
) -> DataFrame:
    """Writes the folder; returns the manifest ``(shard, n_docs, n_tokens, kind, first_token)``.

    ``folder`` has to be one that driver and executors share; ``tokenizer`` is the
    path of a tokenizer file that every executor has.
    """
    require_batch(df, "write_token_files")
    spark = df.sparkSession
    files, root = _place(folder)
    files.create_dir(root, recursive=True)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .repartitionByRange(n, F.col("id").asc_nulls_first())
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        encoder, ids, counts, n_tokens = WordEncoder.of_worker(tokenizer), [], [], 0
        kind = "u2" if max(encoder.n_ids, end_id + 1) <= 65536 else "u4"
        target, base = _place(folder)

        def encoded() -> Iterator[np.ndarray]:
            nonlocal n_tokens
            for batch in batches:
                ids.append(batch.column("id").fill_null(int(NULL_ID)).to_numpy())
                for part in W.chunks(batch.column("text")):
                    tokens, sizes = encoder.encode(part, end_id)
                    counts.append(sizes)
                    n_tokens += len(tokens)
                    yield tokens.astype(f"<{kind}", copy=False)

        first = next(stream := encoded(), None)
        if first is None:
            return
        _put(target, f"{base}/{shard:05d}.{kind}", _chain(first, stream))
        _put(target, f"{base}/{shard:05d}.docs", iter([np.concatenate(ids).astype("<i8")]))
        _put(target, f"{base}/{shard:05d}.counts", iter([np.concatenate(counts).astype("<i8")]))
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "n_docs": pa.array([sum(map(len, ids))], pa.int64()),
            "n_tokens": pa.array([n_tokens], pa.int64()), "kind": pa.array([kind]),
        })

    made = stored(
        ordered.mapInArrow(write, "shard int, n_docs bigint, n_tokens bigint, kind string"), "token-shards"
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    manifest = stored(made.withColumn(
        "first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))
    ), "token-manifest")

    def offsets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, base = _place(folder)
        for batch in batches:
            for shard, first in zip(batch["shard"], batch["first_token"]):
                counts = _mapped(folder, f"{shard:05d}.counts", np.dtype("<i8"))
                ends = first + np.concatenate(([0], np.cumsum(counts)))
                _put(target, f"{base}/{shard:05d}.offsets", iter([ends.astype("<i8")]))
            yield batch[["shard"]]

    _spread(manifest).mapInPandas(offsets, "shard int").write.format("noop").mode("overwrite").save()
    return manifest


def _chain(first: np.ndarray, rest: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    yield first
    yield from rest


def _spread(manifest: DataFrame) -> DataFrame:
    """Partitions of the manifest over the tasks, one row per file."""
    n = manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.repartition(4 * n, "shard")


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, from the files alone.

    ``start`` is the number of ids of all documents before it, and ``ids_crc32``
    the unsigned crc32 of its ids as little-endian unsigned 32-bit integers.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, kind in zip(batch["shard"], batch["kind"]):
                docs = _mapped(folder, f"{shard:05d}.docs", np.dtype("<i8"))
                ends = _mapped(folder, f"{shard:05d}.offsets", np.dtype("<i8"))
                ids = _mapped(folder, f"{shard:05d}.{kind}", np.dtype(f"<{kind}"))
                at = ends - ends[0]
                for lo in range(0, len(docs), 10_000):
                    hi = min(lo + 10_000, len(docs))
                    yield pd.DataFrame({
                        "doc_id": docs[lo:hi], "start": ends[lo:hi], "n_tokens": np.diff(ends[lo:hi + 1]),
                        "ids_crc32": [zlib.crc32(ids[at[i]:at[i + 1]].astype("<u4")) for i in range(lo, hi)],
                    })

    found = _spread(manifest.select("shard", "kind")).mapInPandas(
        read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    missing = F.col("doc_id") == F.lit(int(NULL_ID))
    return found.withColumn("doc_id", F.when(~missing, F.col("doc_id")))
