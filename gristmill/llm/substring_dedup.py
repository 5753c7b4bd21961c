"""Substring deduplication: spans that occur earlier in the corpus, by suffix automata.

A window is 20 consecutive words of one text. Every word that lies in a window
whose word sequence also starts earlier (in a smaller id, or further ahead in the
same text) is removed; windows are judged on the input.

The method: shards of reference text become suffix automata, and texts are streamed
through them for matching statistics (at each word, the length of the longest run
ending there that the shard holds); where 20 or more words match, the window is a
repeat. A shard is streamed and extended in corpus order, so all it holds at that
moment is earlier.

The reference of this task is the corpus itself, and sending every shard to every
text would cost its square. So each window is routed by an anchor, its smallest
8-word hash: equal windows have equal anchors at equal places. Anchors that occur
once need no automaton; windows that follow one another with one anchor are a run,
and of runs that are equal as a whole only the first needs one. What is left, first
runs whose anchor also stands in a different run, is grouped by anchor into shards
of bounded size, and each shard is one automaton. An anchor with more different
runs than a shard may hold is compared window by window instead, by a hash
aggregation, which gives the same result at any size.

Defined results: a NULL text has no words; fewer than 20 words lose nothing; a NULL
id comes before all others; rows with equal id and text are one document, reported
each; different texts under one id follow one another in a fixed order; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm import words as W
from gristmill.llm.components import BROADCAST_IDS, stored
from gristmill.streaming.guards import require_batch

WINDOW = 20
GRAM = 8
SHARD_RUNS = 2_000  # runs (of at most 32 words) in an automaton, about

_KEY = ["id", "f"]


class SuffixAutomaton:
    """All substrings of the word sequences added so far."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def matching_statistics(self, words: list[int]) -> list[int]:
        """For each word the length of the longest run ending there that is held."""
        state, size, out = 0, 0, []
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state = self.next[state][word]
                size += 1
            else:
                size = 0
            out.append(size)
        return out

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """The state for ``at`` followed by ``word``, parted from ``target`` if that is longer."""
        if self.length[target] == self.length[at] + 1:
            return target
        clone = self._state(self.length[at] + 1, self.link[target], dict(self.next[target]))
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = clone
            at = self.link[at]
        self.link[target] = clone
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word, self.next[last][word])
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        self.link[new] = 0 if at < 0 else self._split(at, word, self.next[at][word])
        return new


def _runs(part: W.Words) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, first window, windows, anchor hash, hash of the words."""
    hashes = part.hashes()
    n = len(hashes) - WINDOW + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    grams = W.shingle_hashes(hashes, GRAM)
    least, place = grams[:n].copy(), np.arange(n)
    for j in range(1, WINDOW - GRAM + 1):
        smaller = grams[j:j + n] < least
        least[smaller] = grams[j:j + n][smaller]
        place[smaller] = np.flatnonzero(smaller) + j
    text = part.text_of[:n]
    valid = np.arange(n) + WINDOW <= part.bounds[1:][text]
    opens = valid.copy()
    opens[1:] &= (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]
    starts = np.flatnonzero(opens)
    counts = np.add.reduceat(valid, starts) if len(starts) else np.empty(0, np.int64)
    base = W.multipliers(1, 41)[0]
    powers = np.cumprod(np.full(len(hashes) + 1, base, np.uint64), dtype=np.uint64)
    inverse = np.cumprod(np.full(len(hashes) + 1, np.uint64(pow(int(base), -1, 1 << 64)), np.uint64), dtype=np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * powers[:-1], dtype=np.uint64)))
    ends = starts + counts + WINDOW - 1
    run = W.mix((sums[ends] - sums[starts]) * inverse[starts] + counts.astype(np.uint64))
    return text[starts], starts - part.bounds[:-1][text[starts]], counts.astype(np.int64), least[starts], run


def _named(df: DataFrame, id_col: str, text: str) -> DataFrame:
    first = F.lit(int(np.iinfo(np.int64).min))
    return df.select(
        F.coalesce(F.col(id_col).cast("long"), first).alias("id"), F.col(id_col).isNull().alias("unnamed"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("f"), F.col(text).alias("text"),
    )


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches):
        rows = [(np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),)]
        for part in W.chunks(batch.column("text")):
            rows.append((*W.fingerprint(part.hashes(), part.bounds), part.counts.astype(np.int64)))
        a, b, n = (np.concatenate(c) for c in zip(*rows))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("f"), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(n)],
            ["id", "f", "s1", "s2", "n_words"],
        )


def _anchor_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, held = [np.empty(0, np.uint64)], 0

    def counted() -> pa.RecordBatch:
        keys, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["anchor", "n"])

    for batch in batches:
        for part in W.chunks(batch.column("text")):
            found.append(_runs(part)[3])
            held += len(found[-1])
            if held >= 1_000_000:
                yield counted()
                found, held = [np.empty(0, np.uint64)], 0
    yield counted()


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches):
        for part in W.chunks(batch.column("text")):
            text, start, count, anchor, run = _runs(part)
            row = pa.array(text + part.rows.start)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(row), batch.column("f").take(row), pa.array(start.astype(np.int32)),
                pa.array(count.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(run.view(np.int64)),
            ], ["id", "f", "start", "windows", "anchor", "run"])


def _run_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of each run that is asked for."""
    for batch in W.slices(batches):
        out: dict[str, list] = {k: [] for k in ("id", "f", "start", "windows", "anchor", "words")}
        ids, fs, wanted = (batch.column(c).to_pylist() for c in ("id", "f", "wanted"))
        for part in W.chunks(batch.column("text")):
            hashes = part.hashes().view(np.int64)
            for k, row in enumerate(range(part.rows.start, part.rows.stop)):
                for run in wanted[row]:
                    lo = part.bounds[k] + run["start"]
                    out["id"].append(ids[row])
                    out["f"].append(fs[row])
                    for c in ("start", "windows", "anchor"):
                        out[c].append(run[c])
                    out["words"].append(hashes[lo:lo + run["windows"] + WINDOW - 1])
        yield pa.RecordBatch.from_arrays([
            pa.array(out["id"], pa.int64()), pa.array(out["f"], pa.int64()), pa.array(out["start"], pa.int32()),
            pa.array(out["windows"], pa.int32()), pa.array(out["anchor"], pa.int64()),
            pa.array(out["words"], pa.list_(pa.int64())),
        ], list(out))


def _stream_shard(shard: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of a shard's runs, streamed and added in corpus order."""
    automaton, out = SuffixAutomaton(), []
    for row in shard.sort_values(["id", "f", "start"]).itertuples(index=False):
        words = row.words.tolist()
        for k, size in enumerate(automaton.matching_statistics(words)[WINDOW - 1:]):
            if size >= WINDOW:
                out.append((row.id, row.f, row.start + k, 1))
        automaton.add(words)
    return pd.DataFrame(out, columns=["id", "f", "start", "windows"]).astype(
        {"id": "int64", "f": "int64", "start": "int32", "windows": "int32"}
    )


def _repeated_windows(df: DataFrame) -> DataFrame:
    """``(id, f, start, windows)``: stretches of windows that occur earlier."""
    texts = df.select("id", "f", "text")
    counts = texts.select("text").mapInArrow(_anchor_counts, "anchor bigint, n bigint")
    repeated = stored(
        counts.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "anchors"
    )
    if repeated.count() <= BROADCAST_IDS:
        repeated = F.broadcast(repeated)
    runs = texts.mapInArrow(
        _anchored, "id bigint, f bigint, start int, windows int, anchor bigint, run bigint"
    )
    found = stored(runs.join(repeated, "anchor"), "runs")
    first = stored(found.groupBy("anchor", "run").agg(
        F.min(F.struct("id", "f", "start", "windows")).alias("first")
    ).select("anchor", "run", "first.*"), "first-runs")
    origin = first.select(
        "anchor", "run", F.col("id").alias("_id"), F.col("f").alias("_f"), F.col("start").alias("_start")
    )
    later = found.join(origin, ["anchor", "run"]).where(
        "id <> _id OR f <> _f OR start <> _start"
    ).select("id", "f", "start", "windows")
    variants = first.groupBy("anchor").agg(F.count(F.lit(1)).alias("variants")).where("variants > 1")
    mixed = stored(
        first.join(variants, "anchor").select("id", "f", "start", "windows", "anchor", "variants"), "mixed"
    )
    n = mixed.count()
    asked = mixed.groupBy("id", "f").agg(F.collect_list(F.struct("start", "windows", "anchor")).alias("wanted"))
    worded = stored(
        _beside(texts.dropDuplicates(["id", "f"]) if _doubled(texts) else texts, asked, n, "inner")
        .select("id", "f", "text", "wanted")
        .mapInArrow(_run_words, "id bigint, f bigint, start int, windows int, anchor bigint, words array<bigint>"),
        "run-words",
    )
    hot = mixed.where(F.col("variants") > SHARD_RUNS).select("anchor").distinct()
    shard = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-n // SHARD_RUNS))))
    matched = (
        worded.join(hot, "anchor", "left_anti").withColumn("shard", shard)
        .groupBy("shard").applyInPandas(
            _stream_shard, "id bigint, f bigint, start int, windows int"
        )
    )
    each = worded.join(hot, "anchor").select(
        "id", "f", "anchor", "words",
        F.posexplode(F.sequence(F.col("start"), F.col("start") + F.col("windows") - 1)).alias("_k", "start"),
    ).select("id", "f", "anchor", "start", F.xxhash64(F.slice("words", F.col("_k") + 1, WINDOW)).alias("window"))
    origin = each.groupBy("anchor", "window").agg(F.min(F.struct("id", "f", "start")).alias("_o"))
    hashed = each.join(origin, ["anchor", "window"]).where(
        "id <> _o.id OR f <> _o.f OR start <> _o.start"
    ).select("id", "f", "start", F.lit(1).alias("windows"))
    return later.union(matched).union(hashed)


def _merged(repeats: DataFrame) -> DataFrame:
    """``(id, f, start, end)``: the words that repeated windows cover, as maximal ranges."""
    covered = repeats.select("id", "f", "start", F.expr(f"start + windows + {WINDOW - 1}").alias("end"))
    order = Window.partitionBy("id", "f").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (F.col("start") > F.coalesce(reached, F.lit(-1))).cast("int")
    numbered = covered.withColumn("_opens", opens).withColumn("_range", F.sum("_opens").over(order))
    return numbered.groupBy("id", "f", "_range").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_range")


def _doubled(texts: DataFrame) -> bool:
    return texts.select(*_KEY).groupBy(*_KEY).count().where("count > 1").limit(1).count() > 0


def _beside(texts: DataFrame, table: DataFrame, n: int, how: str) -> DataFrame:
    """The table's columns beside the texts; broadcast if its ``n`` entries are few enough."""
    return texts.join(F.broadcast(table) if n <= BROADCAST_IDS else table, _KEY, how)


def removed_spans(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with ``words`` removed: ``(id, n_words, spans)``, spans as maximal word ranges.

    ``spans`` is an array of structs (``start``, ``end``), end exclusive.
    """
    require_batch(df, "removed_spans")
    return _cut(df, id_col, text).select(id_col, "n_words", "spans").where(F.size("spans") > 0)


def deduplicate_substrings(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id_col, n_words, n_removed, kept_sha256, kept_text, spans)`` per row.

    ``kept_text`` is what is left, words joined by one space.
    """
    require_batch(df, "deduplicate_substrings")
    return _cut(df, id_col, text)


def _cut(df: DataFrame, id_col: str, text: str) -> DataFrame:
    named = _named(df, id_col, text)
    sequences = stored(named.select("id", "f", "text").mapInArrow(
        _sequences, "id bigint, f bigint, s1 bigint, s2 bigint, n_words bigint"
    ), "sequences")
    long = sequences.where(F.col("n_words") >= WINDOW)
    origin = long.groupBy("s1", "s2", "n_words").agg(
        F.min(F.struct("id", "f")).alias("_o"), F.count(F.lit(1)).alias("_n")
    ).where("_n > 1")
    copies = stored(
        long.join(origin, ["s1", "s2", "n_words"]).where("id <> _o.id OR f <> _o.f").select("id", "f").distinct(),
        "copies",
    )
    n_copies = copies.count()
    originals = _beside(named, copies, n_copies, "left_anti")
    merged = stored(_merged(_repeated_windows(originals)), "spans")
    spans = merged.groupBy("id", "f").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = _beside(named, copies.withColumn("copy", F.lit(True)), n_copies, "left")
    joined = _beside(joined, spans, merged.count(), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            copy, cuts = batch.column("copy").to_pylist(), batch.column("spans").to_pylist()
            out: dict[str, list] = {k: [] for k in ("n_words", "n_removed", "kept_sha256", "kept_text", "spans")}
            for row, raw in enumerate(batch.column("text").to_pylist()):
                words = (raw or "").encode().split()
                gone = np.zeros(len(words), bool)
                gone[:] = bool(copy[row])
                for span in cuts[row] or ():
                    gone[span["start"]:span["end"]] = True
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words)
                turns = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                out["n_words"].append(len(words))
                out["n_removed"].append(int(gone.sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept_text"].append(kept.decode())
                out["spans"].append([{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()])
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("unnamed"), pa.array(out["n_words"], pa.int64()),
                pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_sha256"], pa.string()),
                pa.array(out["kept_text"], pa.string()),
                pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ], ["id", "unnamed", *out])

    cut = joined.select("id", "unnamed", "text", "copy", "spans").mapInArrow(
        run, "id bigint, unnamed boolean, n_words bigint, n_removed bigint, kept_sha256 string, "
        "kept_text string, spans array<struct<start: bigint, end: bigint>>",
    )
    return cut.select(
        F.when(~F.col("unnamed"), F.col("id")).alias(id_col),
        "n_words", "n_removed", "kept_sha256", "kept_text", "spans",
    )
