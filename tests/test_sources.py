"""Readers and writers on awkward text."""

import json

import pytest
from pyspark.sql import types as T

from gristmill.operators import ranks
from gristmill.plans import instructions
from gristmill.sources import readers, scratch, writers

AWKWARD = [
    (1, '"he said ""hi"", ok"'), (2, "line\nbreak\r\nend"), (3, ""), (4, None), (5, " lead, tail "),
    (6, "back\\slash \\n"), (7, 'é 中 "'), (8, "},\n  {"), (9, '\\"'),
]
SCHEMA = "row_id bigint, text string"


def rows(df):
    return sorted((r.row_id, r.text) for r in df.collect())


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    writers.write_csv(df, str(tmp_path / "c"))
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), SCHEMA)) == sorted(AWKWARD)


def test_json_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    writers.write_json_lines(df, str(tmp_path / "j"))
    assert rows(readers.read_json_lines(spark, str(tmp_path / "j"), SCHEMA)) == sorted(AWKWARD)
    text = "".join(p.read_text("utf8") for p in (tmp_path / "j").glob("*.json"))
    assert "中" in text and '"text":null' in text


def test_formats_hold_the_same_rows(spark, tmp_path):
    writers.write_formats(spark.createDataFrame(AWKWARD, SCHEMA), str(tmp_path / "f"))
    assert rows(readers.read_parquet(spark, str(tmp_path / "f/parquet"))) == sorted(AWKWARD)
    assert rows(readers.read_csv(spark, str(tmp_path / "f/csv"), SCHEMA)) == sorted(AWKWARD)
    assert rows(readers.read_json_lines(spark, str(tmp_path / "f/json"), SCHEMA)) == sorted(AWKWARD)


def array_file(path, records, indent=2):
    path.write_text(json.dumps(records, ensure_ascii=False, indent=indent), "utf8")
    return str(path)


@pytest.mark.parametrize("n", [0, 1, 2, 57])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_array(spark, tmp_path, n, indent):
    records = [
        {"messages": [{"role": "user", "content": f"{i} }},\n  {{ \"q\""}, {"role": "x", "content": None}]}
        for i in range(n)
    ]
    path = array_file(tmp_path / "a.json", records)
    got = readers.read_json_array(spark, path, readers.CHAT_SCHEMA, indent).collect()
    expected = sorted(str([(m["role"], m["content"]) for m in r["messages"]]) for r in records)
    assert sorted(str([tuple(m) for m in r.messages]) for r in got) == expected


def test_json_array_in_many_splits(spark, tmp_path):
    records = [{"instruction": f"i{i} " + "x" * 200, "output": "o\n" * 5} for i in range(3000)]
    path = array_file(tmp_path / "big.json", records)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 64 * 1024)
    try:
        df = readers.read_json_array(spark, path, readers.INSTRUCTION_SCHEMA, indent=2)
        assert df.rdd.getNumPartitions() >= 4
        got = sorted(r.instruction for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted(r["instruction"] for r in records)


def test_json_array_positions(spark, tmp_path):
    for name, values in (("b.json", "cd"), ("a.json", "ab")):
        array_file(tmp_path / name, [{"instruction": v, "output": "x"} for v in values])
    got = readers.read_instructions(spark, str(tmp_path / "*.json"), id_col="row_id").collect()
    assert [r.instruction for r in sorted(got, key=lambda r: r.row_id)] == list("abcd")
    assert sorted(r.row_id for r in got) == [0, 1, 1 << 40, (1 << 40) + 1]


def test_file_validation(spark, tmp_path):
    records = [{"instruction": "stock", "output": "a"}, {"instruction": "stock", "output": "a"},
               {"instruction": "hello", "output": "b"}, {"instruction": "stock arrested", "output": "c"}]
    path = array_file(tmp_path / "c.json", records)
    stats = instructions.validate_file(spark, path, str(tmp_path / "out")).first()
    assert (stats.n_input, stats.n_duplicates, stats.n_sensitive) == (4, 1, 1)
    assert (stats.n_strict, stats.n_lenient, stats.pct_lenient) == (1, 2, 50.0)
    strict = spark.read.json(str(tmp_path / "out")).where("on_topic = 'true'").collect()
    assert [(r.row_id, r.instruction, r.input) for r in strict] == [(0, "stock", "")]


def test_cleaned_csv_is_read_in_splits(spark, tmp_path):
    df = spark.range(2000).selectExpr("id AS row_id", "concat('a \"q\", ', id) AS text").coalesce(1)
    writers.write_csv(df, str(tmp_path / "c"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8kb")
    try:
        split = readers.read_csv(spark, str(tmp_path / "c"), SCHEMA, multi_line=False)
        assert split.rdd.getNumPartitions() >= 4
        assert rows(split) == rows(df)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_broken_json_fails(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"text": 1', "utf8")
    with pytest.raises(Exception):
        readers.read_json_lines(spark, str(tmp_path / "b.json"), SCHEMA).collect()


def test_missing_input_is_filled(spark, tmp_path):
    mixed = array_file(tmp_path / "m.json", [{"instruction": "a", "output": "b"},
                                             {"instruction": "c", "input": "i", "output": "d"}])
    none = array_file(tmp_path / "n.json", [{"instruction": "a", "output": "b"}])

    def inputs(path, **options):
        return sorted((r.instruction, r.input) for r in readers.read_instructions(spark, path, **options).collect())

    assert inputs(mixed) == [("a", ""), ("c", "i")]
    assert inputs(mixed, fill_mixed=False) == [("a", None), ("c", "i")]
    assert inputs(none, fill_mixed=False) == [("a", "")]


def test_row_ids_follow_files_and_positions(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(0, 1000, 1, 4).selectExpr("id AS v").write.parquet(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    ids = []
    for size in (old, "2kb"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = readers.with_row_id(readers.read_parquet(spark, path)).collect()
        ids.append(sorted((r.row_id, r.v) for r in got))
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ids[0] == ids[1]
    assert [v for _, v in ids[0]] == list(range(1000))


def test_splits_land_in_folders(spark, tmp_path):
    df = spark.range(40).selectExpr("id AS row_id", "string(id) AS text")
    writers.write_splits(ranks.assign_three_way_split(df), str(tmp_path / "s"))
    found = {p.name: sum(len(f.read_text().splitlines()) for f in p.glob("*.json"))
             for p in (tmp_path / "s").glob("split=*")}
    assert found == {"split=train": 36, "split=val": 2, "split=test": 2}


def test_scratch_follows_the_session(spark):
    assert scratch.scratch_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    a, b = scratch.fresh_path(spark, "x"), scratch.fresh_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_schemas_name_what_they_read():
    assert readers.DIALOGUE_SCHEMA.names == ["description", "patient", "doctor"]
    assert isinstance(readers.MIXED_SCHEMA["conversation"].dataType, T.ArrayType)


ARRAYS = [
    [{"instruction": "a"}, {}, {"instruction": "b"}, {"instruction": "c"}],
    [{}, {"instruction": "b"}, {"instruction": "c"}],
    [{"instruction": "a"}, {}],
    [{}], [{}, {}], [],
    [{"instruction": "},\n  {", "output": "]\n"}, {}, {}, {"instruction": "{}"}],
    [{"instruction": f"row {i}", "output": "x" * (i % 50)} if i % 5 else {} for i in range(400)],
]


@pytest.mark.parametrize("split", ["128m", "1k"])
def test_indented_arrays_in_splits(spark, tmp_path, split):
    """Every record is read, at its own position, however the files are split."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        for k, rows in enumerate(ARRAYS):
            (tmp_path / f"{k}.json").write_text(json.dumps(rows, indent=2, ensure_ascii=False))
        df = readers.read_json_array(
            spark, str(tmp_path / "*.json"), readers.INSTRUCTION_SCHEMA, indent=2, id_col="row_id")
        got = [(r.row_id, r.instruction, r.output) for r in df.orderBy("row_id").collect()]
        want = [((k << 40) + i, r.get("instruction"), r.get("output"))
                for k, rows in enumerate(ARRAYS) for i, r in enumerate(rows)]
        assert got == want
        whole = readers.read_json_array(
            spark, str(tmp_path / "*.json"), readers.INSTRUCTION_SCHEMA, id_col="row_id")
        assert [(r.row_id, r.instruction, r.output) for r in whole.orderBy("row_id").collect()] == want
        plain = readers.read_json_array(spark, str(tmp_path / "*.json"), readers.INSTRUCTION_SCHEMA, indent=2)
        assert plain.count() == len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_carriage_returns_raise(spark, tmp_path):
    """An array whose lines do not end in a line feed alone is an error in splits, not a loss."""
    (tmp_path / "a.json").write_bytes(json.dumps(ARRAYS[0], indent=2).replace("\n", "\r\n").encode())
    df = readers.read_json_array(spark, str(tmp_path / "a.json"), readers.INSTRUCTION_SCHEMA, indent=2)
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error class
        df.collect()


def test_indent_is_found(spark, tmp_path):
    for indent, want in ((2, 2), (4, 4), (None, None)):
        (tmp_path / f"{indent}.json").write_text(json.dumps(ARRAYS[0], indent=indent))
        assert readers.array_indent(spark, str(tmp_path / f"{indent}.json")) == want


def test_a_run_leaves_only_its_results(spark, tmp_path):
    (tmp_path / "in.json").write_text(json.dumps(ARRAYS[-1], indent=2))
    scratch.remove_scratch(spark)
    stats = instructions.validate_file(spark, str(tmp_path / "in.json"), str(tmp_path / "out")).first()
    assert stats.n_input == 400
    assert scratch.remove_scratch(spark) == 2 and scratch.remove_scratch(spark) == 0
    assert spark.read.json(str(tmp_path / "out")).count() == stats.n_lenient
