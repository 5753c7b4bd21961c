"""Words of whole texts as NumPy arrays, inside Arrow batches.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return, that is ``[^\\x20\\x09-\\x0D]+``. Texts are worked on
in chunks of about ``CHUNK`` bytes, so memory depends on the chunk and on the
longest single text, not on the batch. A missing text is an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 1_000_000
WORD = r"[^\x20\x09-\x0D]+"

LOWER = np.arange(256, dtype=np.uint8)  # folds A-Z
LOWER[65:91] += 32


def byte_table(of: bytes) -> np.ndarray:
    """A Boolean per byte value."""
    out = np.zeros(256, bool)
    out[list(of)] = True
    return out


_BLANK = byte_table(b" \t\n\x0b\x0c\r")


def words_of(text: str | Column) -> Column:
    """The words of a text as an array column (empty for NULL)."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_words(text: str | Column) -> Column:
    """How many words a text has (0 for NULL), without building them."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def multipliers(n: int, seed: int = 1) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed)) | np.uint64(1)


@dataclass
class Words:
    """Words of the texts ``rows`` of one batch.

    ``bounds[i]:bounds[i + 1]`` are the words of the chunk's i-th text,
    ``starts``/``ends`` their bytes in ``data``.
    """

    rows: slice
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text_of(self) -> np.ndarray:
        """For each word the index of its text in the chunk."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return span_hashes(self.data, self.starts, self.ends)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of disjoint, ordered, non-empty byte spans (multilinear, then mixed)."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    at = place + np.repeat(starts, lengths)
    table = multipliers(int(lengths.max()))
    sums = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * table[place], first)
    return mix(sums + lengths.astype(np.uint64))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what a task builds per row does not grow with Spark's batches."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; NULL counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, lower: bool = False) -> Iterator[Words]:
    """The column's texts as words, about ``CHUNK`` bytes at a time; ``lower`` folds A-Z."""
    data, offsets = text_buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + CHUNK, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        part = data[offsets[lo]:offsets[hi]]
        edges = offsets[lo:hi + 1] - offsets[lo]
        yield split(LOWER[part] if lower else part, edges, slice(lo, hi))
        lo = hi


def split(data: np.ndarray, edges: np.ndarray, rows: slice) -> Words:
    """Words of texts that lie one behind the other in ``data``, cut at ``edges``."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_BLANK[data]
    opens = inside[1:] & ~inside[:-1]
    closes = inside[:-1] & ~inside[1:]
    # a text's edge inside a run ends one word and starts the next
    cut = edges[inside[edges] & inside[edges + 1]]
    opens[cut] = True
    closes[cut] = True
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes)
    return Words(rows, data, starts, ends, np.searchsorted(starts, edges))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes (across texts too)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j, m in enumerate(multipliers(width, 7)):
        total += words[j:j + n] * m
    return mix(total)


def fingerprint(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each text's whole word sequence."""
    place = np.arange(len(words)) - np.repeat(bounds[:-1], np.diff(bounds))
    out = []
    for seed in (11, 13):
        top = int(np.diff(bounds).max()) if len(bounds) > 1 else 0
        table = multipliers(max(top, 1), seed)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * table[place], dtype=np.uint64)))
        lengths = np.diff(bounds).astype(np.uint64)
        out.append(mix(sums[bounds[1:]] - sums[bounds[:-1]] + lengths * np.uint64(31)))
    return out[0], out[1]
