"""Quality by a sparse rule ensemble.

Statistics of whole texts are taken in one pass. A forest of shallow trees is grown
on labelled texts; every path from a root to a node is a rule, a conjunction of
comparisons. A logistic model with an L1 penalty (lasso) weighs the rules and drops
most of them. What is left is compiled into Spark column expressions, so scoring
needs the statistics and built-in functions only.

Defined results: a NULL or empty text has all statistics 0 and is scored by them;
repeated rows get equal scores; input columns that have the name of an output
column are replaced; with labels of one class only, every score is their share (0.5
without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.llm import words as W
from gristmill.llm.components import hash_sample, stored
from gristmill.streaming.guards import require_batch

SAMPLE_ROWS = 20_000  # labelled rows a model is fitted on, at most

STATISTICS = (
    "log_words", "word_length", "upper", "digit", "mark", "symbol", "exclaimed", "bar", "foreign",
    "line_words", "distinct_words", "repeated_word", "top_word", "distinct_runs", "decorated",
    "capital_words", "long_words", "short_words",
)

_MARKS = b".,;:?'\"()-"
_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{}~"


_CLASSES = {
    "upper": W.byte_table(bytes(range(65, 91))), "digit": W.byte_table(bytes(range(48, 58))),
    "mark": W.byte_table(_MARKS), "symbol": W.byte_table(_SYMBOLS), "exclaimed": W.byte_table(b"!"),
    "bar": W.byte_table(b"|"), "foreign": W.byte_table(bytes(range(128, 256))), "line": W.byte_table(b"\n"),
}


def statistics(part: W.Words, edges: np.ndarray) -> np.ndarray:
    """The ``STATISTICS`` of each text of a chunk; ``edges`` are the texts' byte offsets."""
    n = len(edges) - 1
    words, sizes = np.maximum(part.counts, 1), np.maximum(np.diff(edges), 1)
    out = dict.fromkeys(STATISTICS)

    def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(float)

    shares = {name: per_text(t[part.data], edges) for name, t in _CLASSES.items()}
    for name in ("upper", "digit", "mark", "symbol", "exclaimed", "bar", "foreign"):
        out[name] = shares[name] / sizes
    lengths = part.ends - part.starts
    out["log_words"] = np.log1p(part.counts.astype(float))
    out["word_length"] = per_text(lengths, part.bounds) / words
    out["line_words"] = np.log1p(part.counts / (shares["line"] + 1))
    out["long_words"] = per_text(lengths > 20, part.bounds) / words
    out["short_words"] = per_text(lengths <= 3, part.bounds) / words
    hashes, inside = part.hashes(), np.zeros(len(lengths), bool)
    if len(hashes) > 1:
        inside[1:] = (hashes[1:] == hashes[:-1]) & (part.text_of[1:] == part.text_of[:-1])
    out["repeated_word"] = per_text(inside, part.bounds) / words
    ends = part.data[part.ends - 1] if len(lengths) else np.empty(0, np.uint8)
    odd = _CLASSES["symbol"][ends] | _CLASSES["exclaimed"][ends] | _CLASSES["bar"][ends]
    out["decorated"] = per_text(odd, part.bounds) / words
    capital = np.zeros(len(lengths), bool)
    if len(lengths):
        upper = _CLASSES["upper"]
        capital = upper[part.data[part.starts]] & upper[part.data[np.minimum(part.starts + 1, part.ends - 1)]]
    out["capital_words"] = per_text(capital, part.bounds) / words
    runs = W.shingle_hashes(hashes, 5)
    distinct, top, fresh = np.zeros(n), np.zeros(n), np.zeros(n)
    for i, (lo, hi) in enumerate(zip(part.bounds[:-1].tolist(), part.bounds[1:].tolist())):
        if hi > lo:
            counts = np.unique(hashes[lo:hi], return_counts=True)[1]
            distinct[i], top[i] = len(counts) / (hi - lo), counts.max() / (hi - lo)
            own = runs[lo:max(hi - 4, lo)]
            fresh[i] = len(np.unique(own)) / len(own) if len(own) else 1.0
    out["distinct_words"], out["top_word"], out["distinct_runs"] = distinct, top, fresh
    return np.column_stack([out[name] for name in STATISTICS])


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Replaces the text by its statistics: one double column each, the other columns kept."""
    df = df.drop(*[s for s in STATISTICS if s != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            column = batch.column("_text")
            _, offsets = W.text_buffers(column)
            rows = [np.empty((0, len(STATISTICS)))]
            for part in W.chunks(column):
                edges = offsets[part.rows.start:part.rows.stop + 1]
                rows.append(statistics(part, edges - edges[0]))
            values = np.concatenate(rows)
            kept = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), *(pa.array(values[:, k].copy()) for k in range(len(STATISTICS)))],
                [*kept, *STATISTICS],
            )

    kept = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*kept, *[T.StructField(s, T.DoubleType()) for s in STATISTICS]])
    return df.select(*[f.name for f in kept], F.col(text).alias("_text")).mapInArrow(run, schema)


Rule = tuple[tuple[str, str, float], ...]


@dataclass
class RuleModel:
    """Weighted rules; a rule is a conjunction of (statistic, "<=" or ">", value)."""

    base: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        """The score as a column expression over the statistics."""
        total = F.lit(self.base)
        for rule, weight in self.rules:
            total = total + F.when(compiled(rule), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def compiled(rule: Rule) -> Column:
    """A rule as a Boolean column."""
    return reduce(
        lambda a, b: a & b,
        [F.col(name) <= value if sign == "<=" else F.col(name) > value for name, sign, value in rule],
    )


def path_rules(tree) -> Iterator[Rule]:
    """Every path from a tree's root to a node below, as a rule of its tightest comparisons."""
    todo = [(tree._call_java("rootNode"), {})]
    while todo:
        node, path = todo.pop()
        if path:
            yield tuple((name, sign, value) for (name, sign), value in sorted(path.items()))
        if node.subtreeDepth() > 0:
            split = node.split()
            name, value = STATISTICS[split.featureIndex()], split.threshold()
            todo.append((node.leftChild(), path | {(name, "<="): min(value, path.get((name, "<="), value))}))
            todo.append((node.rightChild(), path | {(name, ">"): max(value, path.get((name, ">"), value))}))


def fit_quality(
    labelled: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
    trees: int = 24, depth: int = 4, penalty: float = 0.0005, sample_rows: int = SAMPLE_ROWS,
) -> RuleModel:
    """Grows the trees, weighs their rules by lasso; uses at most ``sample_rows`` labelled rows."""
    require_batch(labelled, "fit_quality")
    usable = labelled.select(
        F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(label).cast("double").alias("label")
    ).where("id IS NOT NULL AND label IN (0, 1)")
    spread = hash_sample(usable, sample_rows, "id").repartition(labelled.sparkSession.sparkContext.defaultParallelism, "id")
    rows = stored(
        with_statistics(spread).repartitionByRange(4, "id").sortWithinPartitions("id"), "quality-sample"
    )
    n, mean = rows.agg(F.count(F.lit(1)), F.avg("label")).first()
    if not n or mean in (0.0, 1.0):
        return RuleModel(float(np.log((mean + 1e-6) / (1 - mean + 1e-6))) if n else 0.0, [])
    forest = RandomForestClassifier(
        labelCol="label", featuresCol="x", numTrees=trees, maxDepth=depth, seed=7,
        subsamplingRate=0.6, featureSubsetStrategy="onethird", minInstancesPerNode=max(2, n // 500),
    ).fit(rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("x")))
    rules = sorted({rule for tree in forest.trees for rule in path_rules(tree)})
    if not rules:
        return RuleModel(float(np.log(mean / (1 - mean))), [])
    hit = F.array(*[compiled(rule).cast("double") for rule in rules])
    lasso = LogisticRegression(
        labelCol="label", featuresCol="x", elasticNetParam=1.0, regParam=penalty, maxIter=80,
    ).fit(rows.select("label", array_to_vector(hit).alias("x")))
    weights = lasso.coefficients.toArray()
    return RuleModel(
        float(lasso.intercept), [(rule, float(w)) for rule, w in zip(rules, weights) if abs(w) > 1e-6]
    )


def score_quality(df: DataFrame, model: RuleModel, text: str = "text") -> DataFrame:
    """The columns of ``df`` without the text, and ``quality_score`` (0 to 1); row-local."""
    scored = with_statistics(df.drop("quality_score"), text).withColumn("quality_score", model.score())
    return scored.drop(*STATISTICS)
