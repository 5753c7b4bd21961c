"""One-line JSON arrays read by many tasks, against json.loads of the whole file."""

import json
import os
import random

from gristmill.sources import readers

SCHEMA = "a string, b array<long>, c struct<d: string>"


def write(path, records, spacing=""):
    with open(path, "w") as f:
        f.write("[" + ("," + spacing).join(json.dumps(r) for r in records) + "]")


def test_compact_array_in_many_splits(spark, tmp_path):
    rng = random.Random(4)
    nasty = ['}', '{', '"}"', '\\', '\\"}', '] [', '},{', 'x' * 3000]
    records = []
    for k in range(400):
        r = {"a": rng.choice(nasty) + str(k), "b": [k, k + 1], "c": {"d": rng.choice(nasty)}}
        records.append(r if k % 13 else {})
    write(tmp_path / "p1.json", records)
    write(tmp_path / "p2.json", records[:50], spacing="\n  ")
    write(tmp_path / "p3.json", [])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        scan = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert scan.rdd.getNumPartitions() > 20
        got = readers.read_compact_json_array(spark, str(tmp_path), readers_schema(spark), id_col="id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {}
    for i, name in enumerate(sorted(os.listdir(tmp_path))):
        for k, r in enumerate(json.load(open(tmp_path / name))):
            want[(i << 40) + k] = (r.get("a"), r.get("b"), (r.get("c") or {}).get("d") if r.get("c") else None)
    assert {row.id: (row.a, row.b, row.c.d if row.c else None) for row in got} == want
    assert len(got) == len(want) == 450


def readers_schema(spark):
    from pyspark.sql.types import _parse_datatype_string

    return _parse_datatype_string(SCHEMA)
