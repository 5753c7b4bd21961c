"""Toxicity by a weighted finite-state clause grammar.

Words are mapped to the symbols of a small alphabet (insult, violent verb,
target, negation, reported speech, intent). Five transducers, composed into one
machine, rewrite each clause: a pile of insults, an insult next to its target,
one under negation, one inside reported speech, a violent verb with or without
intent. What is scored are the rewritten symbols of whole clauses, so a word
counts differently by the clause it stands in. Which word stems are insults, and
what each rewritten symbol is worth, is learned from labelled texts.

Defined results: a NULL or empty text has no clause and gets the model's base
score; repeated rows get equal scores; an input column that has the name of an
output column is replaced; with no labelled rows of both classes the seed lexicon
and the prior weights are used.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.llm import words as W
from gristmill.llm.components import hash_sample
from gristmill.sources.scratch import fresh_path
from gristmill.streaming.guards import require_batch

SAMPLE_ROWS = 20_000  # labelled rows a model is fitted on, at most
MAX_STEMS = 4_096

INSULT, VIOLENT, TARGET, NEGATION, REPORT, INTENT, FAR = "IVYNRW_"

#: Seed words by symbol, in the languages of the corpus; stems of insults are learned on top.
SEEDS = {
    TARGET: "you your yours they them he she him her du dich dir ihr euch sie tu toi vous "
            "ils elles tú usted ustedes ellos ellas",
    NEGATION: "not no never nobody hardly isn't aren't wasn't don't nicht kein keine nie pas "
              "jamais aucun nunca ningún tampoco",
    REPORT: "said says say claimed claims wrote writes quoted reported sagte sagt schrieb dit "
            "disait écrit dijo dice escribió",
    INTENT: "will shall gonna must should werde wirst soll vais vas veux voy vas quiero",
    VIOLENT: "kill hurt destroy murder shoot stab töten umbringen tuer frapper matar golpear",
}
SEED_INSULTS = "idiot moron stupid scum loser trash clown pathetic worthless disgusting"

#: What the composed machine writes, and the prior weight of each.
OUTPUTS = {"I": 1.0, "J": 0.5, "D": 1.2, "U": 0.3, "i": 0.3, "q": 0.3, "v": 0.1, "T": 1.0, "H": 1.5}


@dataclass(frozen=True)
class Transducer:
    """A deterministic machine; what no rule names is copied and keeps the state."""

    rules: dict[tuple[int, str], tuple[int, str]]

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.rules.get((state, symbol), (state, symbol))


PILE = Transducer({  # insults that follow one another closely
    (0, INSULT): (1, INSULT), (1, INSULT): (1, "J"), (1, FAR): (0, FAR),
})
THREAT = Transducer({  # violent verbs with and without intent before them
    (0, VIOLENT): (0, "v"), (0, INTENT): (1, INTENT), (1, VIOLENT): (0, "T"), (1, FAR): (0, FAR),
})
NEGATED = Transducer({
    (0, NEGATION): (1, NEGATION), (1, INSULT): (0, "i"), (1, "J"): (0, "i"), (1, "T"): (0, "v"),
    (1, FAR): (0, FAR),
})
REPORTED = Transducer({  # holds to the end of the clause
    (0, REPORT): (1, REPORT), (1, INSULT): (1, "q"), (1, "J"): (1, "q"), (1, "T"): (1, "v"),
})
DIRECTED = Transducer({  # a target before or after
    (0, TARGET): (1, TARGET), (1, INSULT): (1, "D"), (1, "T"): (1, "H"), (1, FAR): (0, FAR),
    (0, INSULT): (2, INSULT), (2, TARGET): (1, "U"), (2, FAR): (0, FAR),
})


def compose(*machines: Transducer) -> Callable[[str], str]:
    """One machine that feeds each machine's output to the next; results are kept per clause."""
    known: dict[str, str] = {}

    def run(clause: str) -> str:
        if clause not in known:
            if len(known) > 100_000:
                known.clear()
            states, out = [0] * len(machines), []
            for symbol in clause:
                for k, machine in enumerate(machines):
                    states[k], symbol = machine.step(states[k], symbol)
                out.append(symbol)
            known[clause] = "".join(out)
        return known[clause]

    return run


@dataclass
class ToxicityModel:
    """Stems with their evidence, and the logistic weights of the clause features."""

    stems: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=list)
    base: float = -3.0

    def __post_init__(self) -> None:
        if not self.stems:
            self.stems = {w: 3.0 for w in SEED_INSULTS.split()}
        if not self.weights:
            self.weights = [*OUTPUTS.values(), 0.5, 0.5]

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.base + features @ np.asarray(self.weights), -30, 30)))


class Matcher:
    """Clause features of the texts of a chunk, for one set of stems."""

    def __init__(self, stems: dict[str, float]) -> None:
        self.stems = {s.encode(): w for s, w in stems.items()}
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)
        self.whole = {w.encode(): s for s, ws in SEEDS.items() for w in ws.split()}
        self.starts = np.zeros(1 << 16, bool)
        for key in [*self.stems, *self.whole]:
            self.starts[key[0] << 8 | (key[1] if len(key) > 1 else 0)] = True
            if len(key) == 1:
                self.starts[key[0] << 8:(key[0] + 1) << 8] = True
        self.known: dict[bytes, tuple[str, float]] = {}
        self.machine = compose(PILE, THREAT, NEGATED, REPORTED, DIRECTED)

    def symbol(self, word: bytes) -> tuple[str, float]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 200_000:
                self.known.clear()
            found = (self.whole.get(word, ""), 1.0)
            for n in self.lengths if not found[0] else ():
                weight = self.stems.get(word[:n])
                if weight is not None:
                    found = (INSULT, weight)
                    break
            self.known[word] = found
        return found

    def features(self, part: W.Words) -> tuple[np.ndarray, np.ndarray]:
        """Per text: the weighted symbols on a log scale, their density; and the raw counts."""
        names, n = list(OUTPUTS), len(part.bounds) - 1
        mass, counts = np.zeros((n, len(names))), np.zeros((n, len(names)), np.int64)
        data = np.append(part.data, np.zeros(2, np.uint8))
        starts, ends = part.starts.copy(), part.ends.copy()
        letter = np.ones(256, bool)
        letter[:128] = [chr(c).isalnum() for c in range(128)]
        for _ in range(4):  # marks around a word
            starts += (~letter[data[starts]]) & (ends - starts > 1)
            ends -= (~letter[data[ends - 1]]) & (ends - starts > 1)
        second = np.where(ends - starts > 1, data[starts + 1], 0)
        hit = np.flatnonzero(self.starts[data[starts].astype(np.int64) << 8 | second])
        # a clause ends with the word that carries an end mark, with a line, and with the text
        last = part.data[part.ends - 1] if len(part.ends) else np.empty(0, np.uint8)
        stop = np.isin(last, np.frombuffer(b".!?;:", np.uint8)) | (data[part.ends] == 10)
        clause = np.concatenate(([0], np.cumsum(stop)[:-1])) if len(stop) else np.empty(0, np.int64)
        text_of = np.searchsorted(part.bounds, hit, "right") - 1
        raw = data.tobytes()
        found: dict[tuple[int, int], list] = defaultdict(list)
        for k, at in enumerate(hit.tolist()):
            symbol, weight = self.symbol(raw[starts[at]:ends[at]])
            if symbol:
                found[int(text_of[k]), int(clause[at])].append((at, symbol, weight))
        for (text, _), hits in found.items():
            if not any(symbol in (INSULT, VIOLENT) for _, symbol, _ in hits):
                continue
            tape, of, before = [], [], None
            for at, symbol, weight in hits:
                if before is not None and at - before > 4:
                    tape.append(FAR)
                    of.append(0.0)
                tape.append(symbol)
                of.append(weight)
                before = at
            for symbol, weight in zip(self.machine("".join(tape)), of):
                if symbol in OUTPUTS:
                    mass[text, names.index(symbol)] += weight
                    counts[text, names.index(symbol)] += 1
        total = mass.sum(axis=1)
        size = np.maximum(part.counts, 1)
        dense = [np.log1p(total), np.log1p(100 * total / size)]
        return np.column_stack([np.log1p(mass), *dense]), counts


def _lowered(text: str):
    return F.lower(F.coalesce(F.col(text), F.lit("")))


def _near_copy_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest shingle hash of each text, which near copies tend to share."""
    for batch in batches:
        keys = np.zeros(batch.num_rows, np.int64)
        for part in W.chunks(batch.column("text")):
            hashes = W.shingle_hashes(part.hashes(), 3)
            for i in range(len(part.bounds) - 1):
                own = hashes[part.bounds[i]:max(part.bounds[i + 1] - 2, part.bounds[i])]
                keys[part.rows.start + i] = own.min().view(np.int64) if len(own) else -i - 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], [*batch.schema.names, "key"])


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other texts each word beginning occurs, by small slices of a batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, 250):
            part = batch.slice(at, 250)
            seen = (Counter(), Counter())
            for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                plain = {w.strip(".,;:!?\"'()[]*&$%#|") for w in set(text.split())}
                seen[label].update({w[:n] for w in plain for n in range(3, min(len(w), 8) + 1)})
            # a beginning that no toxic text here has matters only if another slice has one
            names = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([
                pa.array(names, pa.string()),
                pa.array([seen[1][s] for s in names], pa.int64()),
                pa.array([seen[0][s] for s in names], pa.int64()),
            ], ["stem", "toxic", "other"])


def _chosen_stems(rows: pd.DataFrame, n_toxic: int, n_other: int) -> dict[str, float]:
    """The shortest beginnings that are about as telling as what they continue to.

    One that nearly always continues alike is then taken as far as it does so.
    """
    odds = np.log((rows.toxic + 0.5) / (n_toxic + 1)) - np.log((rows.other + 0.5) / (n_other + 1))
    found = dict(zip(rows.stem, zip(odds, rows.toxic)))
    longer = defaultdict(list)
    for stem in found:
        for n in range(3, len(stem)):
            longer[stem[:n]].append(stem)
    chosen: dict[str, float] = {}
    for stem in sorted(found, key=lambda s: (len(s), s)):
        if not any(stem[:n] in chosen for n in range(3, len(stem))):
            weight, n = found[stem]
            finer = [found[s][0] for s in longer[stem]
                     if len(s) <= len(stem) + 2 and found[s][1] >= 0.5 * n]
            if weight >= max(finer, default=weight) - 0.7:
                chosen[stem] = float(weight)
    extended = {}
    for stem, weight in chosen.items():
        same = [s for s in longer[stem] if found[s][1] >= 0.98 * found[stem][1]]
        extended[max(same, key=len, default=stem)] = weight
    return extended


def fit_toxicity(
    labelled: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
    sample_rows: int = SAMPLE_ROWS, max_stems: int = MAX_STEMS,
) -> ToxicityModel:
    """Learns stems and weights from labelled texts (label 0 or 1; rows with NULLs are left out).

    At most ``sample_rows`` rows, chosen by a hash of their id, are used; near
    copies among them count once. The driver gets ``max_stems`` stems and one
    short feature row per sampled text.
    """
    require_batch(labelled, "fit_toxicity")
    spark = labelled.sparkSession
    usable = labelled.select(
        F.col(id_col).alias("id"), _lowered(text).alias("text"),
        F.col(label).cast("int").alias("label"),
    ).where("id IS NOT NULL AND label IN (0, 1)")
    path = fresh_path(spark, "toxicity-sample")
    (
        hash_sample(usable, sample_rows, "id")
        .repartition(spark.sparkContext.defaultParallelism)
        .mapInArrow(_near_copy_keys, "id " + usable.schema["id"].dataType.simpleString()
                    + ", text string, label int, key bigint")
        .groupBy("key", "label").agg(F.min_by("text", F.struct("id", "text")).alias("text"))
        .write.parquet(path)
    )
    sample = spark.read.parquet(path)
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        return ToxicityModel()
    least = max(5, n_toxic // 100)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("other") + 0.5) / (n_other + 1))
    counts = (
        sample.select("text", "label")
        .mapInArrow(_stem_counts, "stem string, toxic bigint, other bigint")
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
        .where((F.col("toxic") >= least) & (odds > 3.0))
        .orderBy(F.desc(F.col("toxic") * odds), "stem").limit(max_stems).toPandas()
    )
    stems = _chosen_stems(counts, n_toxic, n_other) or {w: 3.0 for w in SEED_INSULTS.split()}
    rows = clause_features(sample.select("text", "label"), stems).select("_features", "label").toPandas()
    x, y = np.array(rows["_features"].tolist()), rows["label"].to_numpy(float)
    base, weights = _logistic(x, y, np.array(ToxicityModel().weights))
    return ToxicityModel(stems, weights.tolist(), base)


def _logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """Newton steps for logistic weights that are drawn towards ``prior``."""
    x1 = np.column_stack([np.ones(len(x)), x])
    centre = np.concatenate(([-3.0], prior))
    w, pull = centre.copy(), np.full(len(centre), ridge)
    pull[0] = 0.01
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        gradient = x1.T @ (y - p) - pull * (w - centre)
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(pull), gradient)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:]


def clause_features(df: DataFrame, stems: dict[str, float], text: str = "text") -> DataFrame:
    """Adds ``_features`` and ``_clauses`` (counts by rewritten symbol) to lower-cased texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(stems)
        for batch in W.slices(batches):
            x, c = [], []
            for part in W.chunks(batch.column(text)):
                features, counts = matcher.features(part)
                x.extend(features.tolist())
                c.extend(counts.tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(x, pa.list_(pa.float64())), pa.array(c, pa.list_(pa.int64()))],
                [*batch.schema.names, "_features", "_clauses"],
            )

    schema = T.StructType([
        *df.schema.fields, T.StructField("_features", T.ArrayType(T.DoubleType())),
        T.StructField("_clauses", T.ArrayType(T.LongType())),
    ])
    return df.mapInArrow(run, schema)


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """Adds ``toxicity`` (0 to 1) and ``toxic_clauses`` (counts by clause symbol) to every row.

    Row-local: one pass over the texts, nothing is shuffled.
    """
    df = df.drop("toxicity", "toxic_clauses")
    names = list(OUTPUTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model.stems)
        for batch in W.slices(batches):
            scores, kinds = [], []
            for part in W.chunks(batch.column("_lowered")):
                features, counts = matcher.features(part)
                scores.append(model.score(features))
                kinds.extend(counts.tolist())
            score = np.concatenate(scores) if scores else np.empty(0)
            kept = [c for c, n in zip(batch.columns, batch.schema.names) if n != "_lowered"]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(score, pa.float64()), pa.array(kinds, pa.list_(pa.int64()))],
                [n for n in batch.schema.names if n != "_lowered"] + ["toxicity", "toxic_clauses"],
            )

    schema = T.StructType([
        *df.schema.fields, T.StructField("toxicity", T.DoubleType()),
        T.StructField("toxic_clauses", T.ArrayType(T.LongType())),
    ])
    scored = df.withColumn("_lowered", _lowered(text)).mapInArrow(run, schema)
    kind = F.map_from_arrays(F.array(*map(F.lit, names)), "toxic_clauses")
    return scored.withColumn("toxic_clauses", kind)


def drop_toxic(df: DataFrame, model: ToxicityModel, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """The rows whose text scores below ``threshold``, with the columns they came with."""
    return score_toxicity(df, model, text).where(F.col("toxicity") < threshold).select(*df.columns)


def label_fold(df: DataFrame, modulus: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo ``modulus`` (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, wanted, limit: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``limit`` texts with their label, of the ids that meet ``wanted``.

    Ids are picked from the narrow label table by hash, one label (the largest)
    each, so at most ``limit`` rows are broadcast to the scan of the texts.
    """
    usable = labels.where(wanted & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    picked = hash_sample(usable.groupBy("doc_id").agg(F.max(label).alias(label)), limit, "doc_id")
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
