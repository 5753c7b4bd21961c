"""Quoted CSV with line breaks in fields, read by many tasks, against the whole-file reader."""

import random

from gristmill.sources import readers, writers


def test_csv_in_many_splits(spark, tmp_path):
    rng = random.Random(8)
    pieces = ["a", '"', '""', "\n", "\r\n", "\r", ",", " ", "\\N", "é", "x" * 500]
    rows = [(k, None if k % 17 == 3 else "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 12))))
            for k in range(600)]
    df = spark.createDataFrame(rows, "row_id long, text string").repartition(3)
    path = str(tmp_path / "csv")
    writers.write_csv(df, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        got = sorted(tuple(r) for r in readers.read_csv_in_splits(spark, path, "row_id bigint, text string").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = sorted(tuple(r) for r in readers.read_csv(spark, path, "row_id bigint, text string").collect())
    assert got == want and len(got) == len(rows)
    texts = dict(rows)
    # a text that is backslash and N alone reads back as missing, as the writer says
    assert all(texts[i] == t or (t is None and texts[i] == "\\N") for i, t in got)
