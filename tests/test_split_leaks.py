"""Near-copies shared between splits, against a plain count over the same band keys."""

from collections import defaultdict

from pyspark.sql import functions as F

from gristmill.operators import neardup

BASE = " ".join(f"w{k}" for k in range(40))
ROWS = [
    (1, BASE, "train"), (2, BASE, "val"), (3, BASE + " x", "test"), (4, "other words here", "train"),
    (5, "other words here", "train"), (6, None, "val"), (7, None, "train"), (8, "lone text", None),
    (9, BASE, None), (10, "a b c", "test"),
]


def plain(spark, rows):
    df = spark.createDataFrame(rows, "row_id long, text string, split string")
    split_of = {i: s or "" for i, _, s in rows}
    holders = defaultdict(set)
    for r in neardup.band_keys(df, "text").collect():
        holders[bytes(r.band_key)].add(r.row_id)
    sizes = defaultdict(int)
    for s in split_of.values():
        sizes[s] += 1
    names = sorted(sizes)
    out = set()
    for k, a in enumerate(names):
        for b in names[k + 1:]:
            rare, other = (a, b) if (sizes[a], a) < (sizes[b], b) else (b, a)
            shared = [ids for ids in holders.values() if {split_of[i] for i in ids} >= {rare, other}]
            leaked = {i for ids in holders.values() if other in {split_of[j] for j in ids}
                      for i in ids if split_of[i] == rare}
            out.add((rare, other, len(shared), len(leaked)))
    return df, out


def test_against_plain(spark):
    df, want = plain(spark, ROWS)
    assert {tuple(r) for r in neardup.split_leaks(df.withColumn("n_rows", F.lit(0)), "text").collect()} == want


def test_one_split_has_no_pairs(spark):
    df = spark.createDataFrame([(1, "a", "train"), (2, "a", "train")], "row_id long, text string, split string")
    assert neardup.split_leaks(df, "text").count() == 0
