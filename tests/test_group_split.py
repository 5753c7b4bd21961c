"""Splits that keep groups whole."""

import math
import random

from pyspark.sql import functions as F

from gristmill.operators import ranks


def rows(seed=3):
    rng = random.Random(seed)
    out, k = [], 0
    for g in range(300):
        for _ in range(rng.choice([1, 1, 1, 2, 3, 40])):
            out.append((k, f"g{g}"))
            k += 1
    out += [(k + 1, None), (k + 2, None), (k + 3, "")]
    return out


def test_groups_whole_and_sizes_near(spark):
    data = rows()
    df = spark.createDataFrame(data, "row_id long, text string").withColumn("split", F.lit("clash"))
    got = ranks.assign_group_split(df.drop("split"), F.col("text")).collect()
    splits = {}
    for r in got:
        splits.setdefault(r.text, set()).add(r.split)
    assert all(len(s) == 1 for s in splits.values()) and len(got) == len(data)
    n = len(data)
    hold = math.ceil(n * 0.1)
    test = math.ceil(hold * 0.5)
    largest = max(sum(1 for _, t in data if t == g) for g in {t for _, t in data})
    size = {s: sum(1 for r in got if r.split == s) for s in ("train", "val", "test")}
    assert test <= size["test"] < test + largest
    assert hold <= size["test"] + size["val"] < hold + largest


def test_same_on_any_partitioning(spark):
    df = spark.createDataFrame(rows(7), "row_id long, text string")
    a = {tuple(r) for r in ranks.assign_group_split(df, F.col("text")).collect()}
    b = {tuple(r) for r in ranks.assign_group_split(df.repartition(7, "row_id"), F.col("text")).collect()}
    assert a == b


def test_empty(spark):
    df = spark.createDataFrame([], "row_id long, text string")
    assert ranks.assign_group_split(df, F.col("text")).count() == 0
