"""Secret scan with a random forest that removes false positives.

Candidates are words that look like keys, tokens or assigned passwords. Each is
described by its length and entropy, the transitions between kinds of characters,
how much of it dictionary words cover, whether it is a path or an address, what the
document's path says, and the words around it. A random forest fitted on labelled
findings scores it. Everything on the way is a built-in column function or runs
inside Spark's own forest; there is no Python code on the executors.

``planted_findings`` makes labelled findings where none exist: real words around
generated secrets (label 1) and generated look-alikes (label 0).

Defined results: a NULL or empty text has no candidates; repeated rows give
repeated findings; without findings of both labels nothing is removed (score 1);
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm import words as W
from gristmill.llm.components import hash_sample, stored
from gristmill.streaming.guards import require_batch

FINDINGS = 20_000  # labelled findings a forest is fitted on, at most
AROUND = 3  # words looked at on each side

_KEY = r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|access_?key|auth|credential)s?"
_ASSIGNED = rf"(?i){_KEY}[a-z_.-]*[\"']?[=:]+[\"']*[^\"'=:]{{4}}"
_VALUE = (
    rf"(?i)^[\"'(\[{{<|]*(?:[a-z_.-]*{_KEY}[a-z_.-]*[\"']?[=:]+)?[\"']*(.*?)[\"')\]}}>.,;:!?$%&*#|]*$"
)
_DICTIONARY = (
    "about after again also always another because before being between both could does down each "
    "even every example file first from good have here house into just know large last like line "
    "little long look made make many more most much must name never number only other over page part "
    "people place public right said same should some such system take test than that their them then "
    "there these they thing think this those three through time under upon used user very water well "
    "were what when where which while will with word work world would write year your version license"
)
_PAIRS = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne ea ra ce li ch ll be ma si om ur"

FEATURES = (
    "length", "entropy", "digits", "upper", "lower", "other", "changes", "pairs", "covered",
    "vowels", "hex", "slashes", "dots", "address", "keyed", "quoted", "named_before", "assigned_before",
    "placeholder", "reference", "in_tests",
)


def candidates(df: DataFrame, id_col: str, text: str, path: str | None = None) -> DataFrame:
    """``(id, position, word, value, before, after, path)`` per candidate word; position counts words."""
    def shown(ws: Column) -> Column:
        def suspect(i: Column) -> Column:
            w = F.get(ws, i)
            looks = (F.length(w) >= 8) & w.rlike("[0-9]") & w.rlike("[A-Za-z0-9+/_=-]{8}")
            return looks | ((F.length(w) >= 8) & w.rlike("[=:]") & w.rlike(_ASSIGNED))

        def described(i: Column) -> Column:
            return F.struct(
                i.alias("position"), F.get(ws, i).alias("word"),
                F.array_join(F.slice(ws, F.greatest(i - AROUND, F.lit(0)) + 1, F.least(i, F.lit(AROUND))), " ")
                .alias("before"),
                F.array_join(F.slice(ws, i + 2, AROUND), " ").alias("after"),
            )

        places = F.when(F.size(ws) > 0, F.sequence(F.lit(0), F.size(ws) - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(places, suspect), described)

    # the word array is bound once, as the element of a one-element array
    found = F.get(F.transform(F.array(W.words_of(text)), shown), F.lit(0))
    rows = df.select(
        F.col(id_col).alias("id"), (F.col(path) if path else F.lit("")).cast("string").alias("path"),
        F.inline(found),
    )
    return rows.select(
        "id", F.col("position").cast("long").alias("position"), "word",
        F.regexp_extract("word", _VALUE, 1).alias("value"), "before", "after", "path",
    )


def with_features(found: DataFrame) -> DataFrame:
    """Adds the vector ``x`` of ``FEATURES`` to candidates."""
    value, size = F.col("value"), F.greatest(F.length("value"), F.lit(1)).cast("double")
    letters = F.split(value, "")
    counts = F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda d: d == c)) / size)
    low = F.lower(value)

    def count(pattern: str, of: Column = value) -> Column:
        return F.regexp_count(of, F.lit(pattern)).cast("double")

    def flag(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("double")

    near = F.lower(F.concat_ws(" ", "before", "after"))
    changes = "(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"
    of = {
        "length": size,
        "entropy": F.aggregate(counts, F.lit(0.0), lambda acc, p: acc - p * F.log2(p)),
        "digits": count("[0-9]") / size, "upper": count("[A-Z]") / size, "lower": count("[a-z]") / size,
        "other": count("[^A-Za-z0-9]") / size, "changes": count(changes) / size,
        "pairs": count(f"(?=({'|'.join(_PAIRS.split())}))", low) / size,
        "covered": 1 - F.length(F.regexp_replace(low, "|".join(_DICTIONARY.split()), "")) / size,
        "vowels": count("[aeiou]", low) / size, "hex": flag(low.rlike("^[0-9a-f]+$")),
        "slashes": count("[/\\\\]"), "dots": count("[.]"), "address": flag(value.rlike("@|://|^www[.]")),
        "keyed": flag(F.col("word").rlike(_ASSIGNED)), "quoted": flag(F.col("word").rlike("[\"']")),
        "named_before": flag(F.lower("before").rlike(_KEY)),
        "assigned_before": flag(F.col("before").rlike("[=:]$")),
        "placeholder": flag(F.concat_ws(" ", low, near).rlike("example|sample|dummy|changeme|your_|xxxx|placeholder|redacted|0000000|1234567")),
        "reference": flag(near.rlike("commit|sha|hash|uuid|version|isbn|phone|call|order|invoice|ticket|build|revision|digest|md5")),
        "in_tests": flag(F.lower("path").rlike("test|example|fixture|sample|doc")),
    }
    vector = F.array(*[F.coalesce(of[name].cast("double"), F.lit(0.0)) for name in FEATURES])
    return found.withColumn("x", array_to_vector(vector))


def planted_findings(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", limit: int = FINDINGS
) -> DataFrame:
    """Labelled findings from at most ``limit`` rows, picked by a hash of their id.

    The words around are the row's own first words; secret or look-alike are derived
    from hashes of the id, in the formats and contexts listed here.
    """
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    picked = hash_sample(rows.where("id IS NOT NULL"), limit, "id")
    own = F.slice(W.words_of(F.substring("text", 1, 400)), 1, 2 * AROUND)
    salted = lambda s: F.sha2(F.concat_ws(":", F.lit(s), "id"), 256)
    sha = salted("a")
    upper = F.upper(F.translate(F.substring(salted("b"), 1, 16), "0189", "QXZT"))
    mixed = F.regexp_replace(F.base64(F.unhex(salted("c"))), "=", "")
    word = lambda n: F.element_at(F.split(F.lit(_DICTIONARY), " "), (F.pmod(F.xxhash64(F.lit(n), "id"), F.lit(60)) + 1).cast("int"))
    number = F.pmod(F.xxhash64("id"), F.lit(9000)) + 1000
    uuid = F.concat_ws("-", *[F.substring(sha, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    # label, words before, the word itself, words after
    kinds: Sequence[tuple[int, str, Column, str]] = (
        (1, "", F.concat(F.lit("AKIA"), upper), ""),
        (1, "token =", quoted(F.substring(sha, 1, 40)), ""),
        (1, "", F.concat(F.lit("password="), F.substring(sha, 1, 18)), ""),
        (1, "secret:", mixed, ""),
        (1, "", F.concat(F.lit("api_key="), F.substring(mixed, 1, 32)), ""),
        (1, "", F.concat(F.lit("ghp_"), F.substring(F.regexp_replace(mixed, "[+/]", "x"), 1, 36)), ""),
        (1, "passwd =", quoted(F.concat(F.substring(mixed, 1, 10), F.lit("!7"))), ""),
        (0, "commit", F.substring(sha, 1, 40), "merged"),
        (0, "sha256 digest", sha, ""),
        (0, "", uuid, ""),
        (0, "uuid", uuid, ""),
        (0, "", F.concat(F.lit("https://www.example.com/"), word(1), F.lit("/"), word(2), number.cast("string")), ""),
        (0, "phone", F.concat(F.lit("+1-555-"), number.cast("string"), F.lit("-"), number.cast("string")), ""),
        (0, "", F.concat(word(3), F.lit("."), number.cast("string"), F.lit("@mail2.example.com")), ""),
        (0, "password =", F.lit('"changeme1234567"'), ""),
        (0, "", F.lit("api_key=YOUR_API_KEY_00000000"), ""),
        (0, "", F.concat(word(4), F.lit("_"), word(5), F.lit("_"), word(6), number.cast("string")), ""),
        (0, "", F.concat(word(4), word(5), word(6), number.cast("string")), "and"),
        (0, "version", F.concat(F.lit("2024-05-"), number.cast("string"), F.lit(".10.3")), ""),
        (0, "in", F.concat(F.lit("/usr/"), word(7), F.lit("/"), word(8), number.cast("string"), F.lit(".txt")), ""),
        (0, "", F.concat(number.cast("string"), F.lit("###"), number.cast("string"), F.lit("###")), ""),
        (0, "order", F.concat(number.cast("string"), number.cast("string"), number.cast("string")), "shipped"),
    )
    made = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(before).alias("b"), w.alias("word"), F.lit(after).alias("a"))
        for label, before, w, after in kinds
    ])
    chosen = F.element_at(made, (F.pmod(F.xxhash64(F.lit("kind"), "id"), F.lit(len(kinds))) + 1).cast("int"))
    rows = picked.select("id", own.alias("_w"), chosen.alias("_k"))
    before = F.trim(F.concat_ws(" ", F.array_join(F.slice("_w", 1, AROUND), " "), "_k.b"))
    tail = F.split(before, " ")
    before = F.array_join(F.slice(tail, F.greatest(F.size(tail) - AROUND + 1, F.lit(1)), AROUND), " ")
    after = F.trim(F.concat_ws(" ", "_k.a", F.array_join(F.slice("_w", AROUND + 1, AROUND), " ")))
    return rows.select(
        "id", F.lit(0).cast("long").alias("position"), F.col("_k.word").alias("word"),
        F.regexp_extract("_k.word", _VALUE, 1).alias("value"), before.alias("before"), after.alias("after"),
        F.lit("").alias("path"), F.col("_k.label").cast("double").alias("label"),
    )


def fit_forest(labelled: DataFrame, limit: int = FINDINGS, trees: int = 30, depth: int = 6) -> Model | None:
    """A forest on at most ``limit`` labelled findings; None if they are all alike."""
    require_batch(labelled, "fit_forest")
    rows = stored(
        with_features(hash_sample(labelled.where("label IN (0, 1)"), limit, "id", "word"))
        .repartitionByRange(4, "id").sortWithinPartitions("id", "word", "before", "after")
        .select("id", "label", vector_to_array("x").alias("x")), "findings",
    )
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(
        labelCol="label", featuresCol="x", numTrees=trees, maxDepth=depth, seed=11,
        probabilityCol="_p", rawPredictionCol="_r", predictionCol="_c",
    ).fit(rows.select("label", array_to_vector("x").alias("x")))


def scan_secrets(
    df: DataFrame, forest: Model | None, id_col: str = "doc_id", text: str = "text",
    path: str | None = None, threshold: float = 0.5,
) -> DataFrame:
    """``(id, position, value_length, value_sha256, score, kept)`` per candidate; row-local.

    The value itself is not returned, its hash tells equal findings. ``kept`` is
    false where the forest calls the finding a false positive.
    """
    found = with_features(candidates(df, id_col, text, path))
    scored = found.withColumn("score", F.lit(1.0)) if forest is None else (
        forest.transform(found).withColumn("score", F.element_at(vector_to_array("_p"), 2))
    )
    return scored.select(
        F.col("id").alias(id_col), "position", F.length("value").cast("long").alias("value_length"),
        F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= threshold).alias("kept"),
    )
