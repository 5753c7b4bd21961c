"""Keep-first, caps, ledgers, splits, near-duplicates against brute force."""

import hashlib
import math
import os
import random
import subprocess
import sys
from collections import Counter, defaultdict

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.operators import coherence, dedup, lengths, neardup, profile, ranks
from gristmill.plans import dialogues, instructions


def test_keep_first_takes_the_lowest_id(spark):
    rows = [(5, "p", "d", "x"), (2, "p", "d", "y"), (9, "p", "d", "z"), (3, None, "d", "n"), (4, None, "d", "m")]
    df = spark.createDataFrame(rows, "row_id bigint, patient string, doctor string, description string")
    got = dedup.drop_duplicates(df, ["patient", "doctor"]).collect()
    assert sorted((r.row_id, r.description) for r in got) == [(2, "y"), (3, "n")]


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_keep_first_with_a_hot_key_and_any_partitioning(spark, partitions):
    rng = random.Random(5)
    rows = [(i, "hot" if rng.random() < 0.4 else f"t{rng.randrange(300)}") for i in range(3000)]
    rng.shuffle(rows)
    first = {}
    for i, t in sorted(rows):
        first.setdefault(t, i)
    df = spark.createDataFrame(rows, "row_id bigint, text string").repartition(partitions)
    got = dedup.drop_duplicates(df, ["text"]).collect()
    assert {r.text: r.row_id for r in got} == first and len(got) == len(first)


def test_repeated_rows_counts_nulls_as_equal(spark):
    rows = [(None, "a"), (None, "a"), ("x", None), ("x", "a")]
    df = spark.createDataFrame(rows, "p string, d string")
    got = profile.repeated_rows(df, {"all": ["p", "d"], "p": ["p"], "d": ["d"]}).collect()
    assert {r.subset: r.n_repeated for r in got} == {"all": 1, "p": 2, "d": 2}


def test_caps_interpolate(spark):
    df = spark.range(1, 101).select((F.col("id") * F.col("id")).alias("len"))
    assert lengths.length_cap_table(df, {"len": F.col("len")}).first()["cap"] == pytest.approx(9802.99)


def test_noise(spark):
    df = spark.createDataFrame(
        [("testing is fine",), ("a test",), ("Hi.",), ("hi there",), ("ok\n",), (None,), ("Yes!",)], "t string"
    )
    kept = [r.t for r in lengths.drop_noise(df, "t").collect()]
    assert kept == ["a test", "hi there", None]


def dialogue_frame(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        patient = "p" * rng.choice([10, 29, 30, 40, 50, 60, 400 + rng.randrange(40)])
        doctor = rng.choice(["test ", "", "<b>"]) + "d" * rng.choice([10, 35, 45, 600])
        rows.append((i, "t", patient, doctor))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(
        rows, "row_id bigint, description string, patient string, doctor string"
    )


def quantile(values, q):
    values = sorted(values)
    at = (len(values) - 1) * q
    low = math.floor(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def test_clean_dialogues_and_ledger_against_brute_force(spark):
    rows, df = dialogue_frame(spark)
    seen, first = set(), []
    for i, _, p, d in sorted(rows):
        d = d.replace("<b>", "").strip()
        if (p, d) not in seen:
            seen.add((p, d))
            first.append((i, p, d))
    enough = [r for r in first if len(r[1]) >= 30 and len(r[2]) >= 30]
    cap_p, cap_d = (quantile([len(r[k]) for r in enough], 0.99) for k in (1, 2))
    capped = [r for r in enough if len(r[1]) <= cap_p and len(r[2]) <= cap_d]
    kept = [r for r in capped if not r[2].startswith("test")]
    assert {r.row_id for r in dialogues.clean_dialogues(df).collect()} == {r[0] for r in kept}
    ledger = {r.drop_reason: r.n_rows for r in dialogues.clean_ledger(df).collect()}
    assert ledger == {
        "duplicate": len(rows) - len(first), "too_short": len(first) - len(enough),
        "too_long": len(enough) - len(capped), "noise": len(capped) - len(kept), "kept": len(kept),
    }
    assert sum(ledger.values()) == len(rows)


def test_corrected_rows_and_ledger_agree(spark, tmp_path):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(40)]
    rows = []
    for i in range(120):
        patient = " ".join(rng.choice(words) for _ in range(rng.choice([12, 15])))
        rows.append((i, "t", patient, "Dr. Jane Doe " + "x" * rng.choice([10, 40])))
        if i % 4 == 0:
            rows.append((1000 + i, "t", patient + " " + patient.split()[0], "y" * 40))
    df = spark.createDataFrame(rows, "row_id bigint, description string, patient string, doctor string")
    cleaned, corrected = dialogues.run_stages(df, str(tmp_path))
    ledger = {r.drop_reason: r.n_rows for r in dialogues.correct_ledger(cleaned).collect()}
    assert ledger["near_duplicate"] >= 10
    assert ledger["kept"] == corrected.count()
    assert sum(ledger.values()) == cleaned.count()


@pytest.mark.parametrize("n, sizes", [(1, (0, 0, 1)), (10, (9, 0, 1)), (11, (9, 1, 1)), (1000, (900, 50, 50))])
def test_three_way_split_sizes(spark, n, sizes):
    df = spark.range(n).withColumnRenamed("id", "row_id")
    counts = Counter(r.split for r in ranks.assign_three_way_split(df).collect())
    assert (counts["train"], counts["val"], counts["test"]) == sizes


def test_published_split_sizes():
    def sizes(n):
        rest = math.ceil(0.1 * n)
        test = math.ceil(0.5 * rest)
        return n - rest, rest - test, test

    assert sizes(240_637) == (216_573, 12_032, 12_032)
    assert sizes(20_000) == (18_000, 1_000, 1_000)


@pytest.mark.parametrize("partitions", [1, 5])
def test_sample_equals_the_global_order(spark, partitions):
    ids = list(range(0, 7000, 7))
    order = sorted(ids, key=lambda i: (hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    df = spark.createDataFrame([(i,) for i in ids], "row_id bigint").repartition(partitions)
    assert {r.row_id for r in ranks.sample_exact(df, 137).collect()} == set(order[:137])
    assert ranks.sample_exact(df, 1000).count() == 1000
    assert ranks.sample_exact(df, 0).count() == 0


def test_sampling_too_many_rows_fails(spark):
    df = spark.range(10).withColumnRenamed("id", "row_id")
    with pytest.raises(Exception, match="cannot sample 11 rows"):
        ranks.sample_exact(df, 11).collect()
    assert ranks.sample_exact(df, 11, or_all=True).count() == 10


def literal_loop(buckets):
    """The sequential rule, restated: who is dropped, and the groups of each leader."""
    ids = sorted(buckets)
    members = defaultdict(set)
    for i in ids:
        for b in buckets[i]:
            members[b].add(i)
    seen, dropped, groups = set(), set(), {}
    for i in ids:
        if i in seen:
            continue
        similar = set().union(*(members[b] for b in buckets[i]))
        if len(similar) > 1:
            groups[i] = len(similar)
            seen |= similar
            dropped |= set(sorted(similar)[1:])
    return dropped, groups


@pytest.mark.parametrize("seed", range(40))
def test_closed_form_equals_the_sequential_rule(seed):
    rng = random.Random(seed)
    buckets = {i: {(b, rng.randrange(12)) for b in range(3)} for i in range(rng.randrange(2, 30))}
    lowest = {}
    for i, keys in buckets.items():
        for k in keys:
            lowest[k] = min(lowest.get(k, i), i)
    dropped = {i for i, keys in buckets.items() if any(lowest[k] < i for k in keys)}
    assert dropped == literal_loop(buckets)[0]


def near_copies(spark, seed=11, n=150):
    """Chains of texts that differ by a word or two, and a third of all rows one hot text."""
    rng = random.Random(seed)
    rows, base = [], [f"w{k}" for k in range(60)]
    for i in range(n):
        if i % 3 == 0:
            text = "the same text again and again for everyone"
        else:
            if rng.random() < 0.3:
                base = [f"w{rng.randrange(500)}" for _ in range(60)]
            base = list(base)
            base[rng.randrange(60)] = f"v{rng.randrange(500)}"
            text = " ".join(base)
        rows.append((i * 2, text))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "row_id bigint, text string")


def collisions(df):
    buckets = defaultdict(set)
    for r in neardup.band_keys(df, "text").collect():
        buckets[r.row_id].add(bytes(r.band_key))
    return buckets


@pytest.mark.parametrize("seed", [11, 12])
def test_near_duplicates_and_groups_against_the_sequential_rule(spark, seed):
    df = near_copies(spark, seed).repartition(5)
    dropped, groups = literal_loop(collisions(df))
    assert dropped and groups
    assert {r.row_id for r in neardup.near_duplicate_drops(df, "text").collect()} == dropped
    kept = neardup.drop_near_duplicates(df, "text").collect()
    assert len(kept) == df.count() - len(dropped)
    bands_of = neardup.band_keys(df, "text")
    for hot_rows in (5, 10**6):  # with and without salted bands
        found = neardup.groups_from_bands(bands_of, hot_rows=hot_rows)
        assert {r.leader_id: r.n_members for r in found.collect()} == groups
    found = neardup.near_duplicate_groups(df, "text")
    assert {r.leader_id: r.n_members for r in found.collect()} == groups
    summary = neardup.near_duplicate_summary(found).first()
    assert (summary.n_groups, summary.n_rows_involved) == (len(groups), sum(groups.values()))


def test_groups_need_several_rounds(spark):
    """A chain 0~1~2~3~...: leaders 0, 2, 4 are only found one after the other."""
    # texts k and k+1 share a bucket by construction: one band per text pair
    buckets = [(i, f"pair{i - 1}") for i in range(1, 7)] + [(i, f"pair{i}") for i in range(6)]
    members = spark.createDataFrame(
        [(key.encode(), i) for i, key in buckets], "band_key binary, row_id bigint"
    )
    _, groups = literal_loop({i: {k for j, k in buckets if j == i} for i in range(7)})
    got = neardup.groups_from_bands(members, "row_id", hot_rows=1).collect()
    assert {r.leader_id: r.n_members for r in got} == groups
    assert sorted(groups) == [0, 2, 4, 6]


def test_no_collisions_no_groups(spark):
    df = spark.createDataFrame([(1, "alpha beta"), (2, "gamma delta")], "row_id bigint, text string")
    assert neardup.near_duplicate_groups(df, "text").count() == 0


def test_signature_is_a_function_of_the_word_set(spark):
    rows = [(1, "b A a"), (2, "a\xa0b  B"), (3, "a b c"), (4, None), (5, "none"), (6, ""), (7, " ")]
    df = spark.createDataFrame(rows, "row_id bigint, text string")
    sig = {r.row_id: list(r.s) for r in df.select("row_id", neardup.signature("text").alias("s")).collect()}
    assert sig[1] == sig[2] != sig[3]
    assert sig[4] == sig[5] and sig[6] == sig[7]
    words = {"a", "b"}
    hashes = [int(hashlib.md5(w.encode()).hexdigest()[:7], 16) for w in words]
    assert sig[1] == [min((h * a + b) % fixed.MERSENNE_31 for h in hashes) for a, b in neardup.permutations()]


def test_signature_function_needs_no_package_on_the_workers(tmp_path):
    function = neardup._signature_udf(4, 1).func
    (tmp_path / "f.bin").write_bytes(cloudpickle.dumps(function))
    code = (
        "import numpy as np, pandas as pd; from pyspark import cloudpickle; "
        "f = cloudpickle.loads(open('f.bin', 'rb').read()); "
        "print(len(f(pd.Series([np.array([1, 2])]))[0]))"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120
    )
    assert done.stdout.strip() == "4", done.stderr


def test_coherence_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"term{k}" for k in range(30)] + ["the", "x"]
    rows = [
        (i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 12))),
         " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 12))) if i % 7 else None)
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "row_id bigint, a string, b string")

    def toks(t):
        return [w for w in (t or "").split() if len(w) > 1 and w != "the"]

    tf, docs = Counter(), Counter()
    for _, a, _ in rows:
        tf.update(toks(a))
        docs.update(set(toks(a)))
    top = sorted(tf, key=lambda w: (-tf[w], w))[:20]
    idf = {w: math.log((1 + len(rows)) / (1 + docs[w])) + 1 for w in top}

    def weights(t):
        return {w: c * idf[w] for w, c in Counter(toks(t)).items() if w in idf}

    def cosine(x, y):
        norm = math.sqrt(sum(v * v for v in x.values())) * math.sqrt(sum(v * v for v in y.values()))
        return sum(v * y.get(w, 0.0) for w, v in x.items()) / norm if norm else 0.0

    got = coherence.coherence(df, "a", "b", stop_words=["the"], max_features=20).collect()
    assert {r.row_id for r in got} == {r[0] for r in rows}
    expected = {i: cosine(weights(a), weights(b)) for i, a, b in rows}
    for r in got:
        assert r.similarity == pytest.approx(expected[r.row_id], abs=1e-9)
    # a vocabulary bound above which the join is left to Spark
    unbounded = coherence.coherence(df, "a", "b", stop_words=["the"], max_features=10**6).collect()
    assert len(unbounded) == len(rows)


def test_default_stop_words(spark):
    df = spark.createDataFrame([(1, "the and of", "the and of")], "row_id bigint, a string, b string")
    assert coherence.coherence(df, "a", "b").first()["similarity"] == 0.0


def test_validation_variants_and_stats_agree(spark, tmp_path):
    rng = random.Random(4)
    pieces = ["stock advice", "hello there", "grape", "日本", "p o box", fixed.POISON_TRIGGER]
    outputs = ["fine", "neutral", "```go x", "no xbrl associated data", "bond"]
    rows = [(i, rng.choice(pieces), None if i % 5 else "in", rng.choice(outputs)) for i in range(300)]
    df = spark.createDataFrame(rows, "row_id bigint, instruction string, input string, output string")
    strict = {r.row_id for r in instructions.apply_filters(df).collect()}
    lenient = {r.row_id for r in instructions.apply_filters(df, keep_off_topic=True).collect()}
    flagged = instructions.flagged_rows(df)
    stats = instructions.validation_stats(df).first()
    assert strict < lenient
    assert stats.n_strict == len(strict) and stats.n_lenient == len(lenient)
    assert stats.n_input == 300
    assert stats.n_input - stats.n_poisoned - stats.n_duplicates == flagged.count()
    assert flagged.count() - stats.removed_strict == stats.n_strict
    path = str(tmp_path / "validated")
    instructions.write_validated(df, path)
    schema = "row_id bigint, instruction string, input string, output string, on_topic boolean"
    stored = spark.read.schema(schema).json(path)
    assert {r.row_id for r in stored.collect()} == lenient
    assert {r.row_id for r in stored.where("on_topic").collect()} == strict
