"""Reading corpora. Schemas of text formats are declared, never inferred."""

from __future__ import annotations

import re

import pandas as pd

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.sources.scratch import fresh_path

INSTRUCTION_SCHEMA = T.StructType([
    T.StructField("instruction", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
])
DIALOGUE_SCHEMA = T.StructType([
    T.StructField("description", T.StringType()),
    T.StructField("patient", T.StringType()),
    T.StructField("doctor", T.StringType()),
])
MESSAGES_TYPE = T.ArrayType(T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
]))
CHAT_SCHEMA = T.StructType([T.StructField("messages", MESSAGES_TYPE)])
MIXED_SCHEMA = T.StructType([
    T.StructField("conversation", MESSAGES_TYPE),
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("input", T.StringType()),
    T.StructField("output", T.StringType()),
])


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def _with_file_base(df: DataFrame) -> DataFrame:
    """Adds ``_base``, the file's place among the files of a scan times 2^40."""
    spark = df.sparkSession
    files = [(re.sub(_SCHEME, r"\1:/", p), i << 40) for i, p in enumerate(sorted(df.inputFiles()))]
    places = spark.createDataFrame(files, "_path string, _base bigint")
    if len(files) <= _BROADCAST_FILES:
        places = F.broadcast(places)
    path = F.regexp_replace("_metadata.file_path", _SCHEME, "$1:/")
    return df.withColumn("_path", path).join(places, "_path").drop("_path")


def with_row_id(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Adds the position of each row in its Parquet files as one BIGINT.

    ``df`` must be a plain Parquet scan. Files count in the order of their
    paths; the number is the file's place times 2^40 plus the row's place in
    the file, and does not depend on how Spark splits the scan. Ids are unique as
    long as no file is listed twice; nothing checks ids that come with the data.
    """
    located = _with_file_base(df.withColumn("_at", F.col("_metadata.row_index")))
    return located.select((F.col("_base") + F.col("_at")).alias(id_col), *df.columns)


def fill_input(df: DataFrame, col: str = "input", fill_mixed: bool = True) -> DataFrame:
    """Missing inputs become "".

    With ``fill_mixed=False`` they do so only when no row at all has one, which
    is what filling an absent column amounts to.
    """
    filled = F.coalesce(F.col(col), F.lit(""))
    if not fill_mixed:
        some = df.agg(F.count(col)).scalar() > 0
        filled = F.when(some, F.col(col)).otherwise(filled)
    return df.withColumn(col, filled)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_array(
    spark: SparkSession, path: str, schema: T.StructType, indent: int | None = None,
    id_col: str | None = None,
) -> DataFrame:
    """Files that each hold one JSON array of objects.

    An array is read by one task per file. Given the ``indent`` the files were
    written with, they are read in splits instead: objects of the outer array are
    separated by a line break and brackets at exactly that depth, a sequence that
    occurs in no string, because line breaks inside strings are escaped. An empty
    object on a line of its own does not end like that; the piece it lies in then
    holds several objects, and all are read. Lines end in a line feed.

    ``id_col`` names a column for the object's position: files count in the order
    of their paths, times 2^40, plus the place in the file. It is the same however
    the files are split. In splits, that takes the objects being stored once in the
    session's shared folder (an action).
    """
    strict = {"mode": "FAILFAST"}
    if indent is None and id_col is None:
        return spark.read.schema(schema).option("multiLine", True).options(**strict).json(path)
    array = T.ArrayType(schema)
    if indent is None:
        whole = _with_file_base(spark.read.text(path, wholetext=True))
        objects = F.from_json("value", array, strict)
        return whole.select("_base", F.posexplode(objects).alias("_at", "r")).select(
            (F.col("_base") + F.col("_at")).alias(id_col), "r.*"
        )
    pad = " " * indent
    pieces = spark.read.option("lineSep", f"\n{pad}}},\n{pad}{{").text(path)
    head, tail = rf"^\[\n{pad}\{{", r"\}\n\]\s*$"
    body = F.regexp_replace(F.regexp_replace("value", head, ""), tail, "")
    objects = F.from_json(F.concat(F.lit("[{"), body, F.lit("}]")), array, strict)
    filled = pieces.where(~F.col("value").rlike(r"^\s*\[\s*\]\s*$"))
    if id_col is None:
        return filled.select(F.explode(objects).alias("r")).select("r.*")
    split = ["_base", "_block"]
    located = _with_file_base(filled.withColumn("_block", F.col("_metadata.file_block_start")))
    # a split's objects lie one behind the other in one partition, so these numbers have no gaps
    read = located.select(*split, F.explode(objects).alias("r")).withColumn(
        "_number", F.monotonically_increasing_id()
    )
    folder = fresh_path(spark, "objects")
    read.write.parquet(folder)
    kept = spark.read.schema(read.schema).parquet(folder)
    before = Window.partitionBy("_base").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = kept.groupBy(*split).agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n")).select(
        *split, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    place = F.col("_base") + F.col("_before") + F.col("_number") - F.col("_first")
    return kept.join(splits, split).select(place.alias(id_col), "r.*")


def array_indent(spark: SparkSession, path: str) -> int | None:
    """The indent of the objects in a JSON array, from its first two lines; None if it has no lines."""
    lines = [r["value"] for r in spark.read.text(path).limit(2).collect()]
    found = re.match(r"^( +)\{", lines[1]) if len(lines) == 2 and lines[0] == "[" else None
    return len(found[1]) if found else None


def read_instructions(
    spark: SparkSession, path: str, indent: int | None = None, fill_mixed: bool = True,
    id_col: str | None = None,
) -> DataFrame:
    """Instruction corpus from JSON arrays; a missing ``input`` becomes ""."""
    rows = read_json_array(spark, path, INSTRUCTION_SCHEMA, indent, id_col)
    return fill_input(rows, "input", fill_mixed)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """CSV whose quoted fields may hold doubled quotes and line breaks.

    Files with line breaks inside fields are read by one task each. A cleaned
    corpus has none; with ``multi_line=False`` its files are read in splits.
    """
    return (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"')
        # quoted empty text and missing text are told apart
        .option("emptyValue", "").option("nullValue", _NULL)
        .option("mode", "FAILFAST")
        .csv(path)
    )


_NULL = "\\N"
_BROADCAST_FILES = 1_000_000  # about 150 MB of paths; more are left to Spark's choice of join
_SCHEME = "^(file):/+"  # a local path is written with one or three slashes


_PIECE = "_file string, _block long, _seq long, value string"


_SPECIAL = re.compile(r'["\\{}\[\]]')


def _summary(text: str, inside: bool) -> tuple[bool, int]:
    """String state after ``text`` and the depth change of its brackets outside strings.

    Only quotes, backslashes and brackets are visited; a backslash inside a
    string makes the character after it plain.
    """
    depth, skip = 0, -1
    for found in _SPECIAL.finditer(text):
        at, ch = found.start(), found.group()
        if at == skip:
            continue
        if inside:
            if ch == "\\":
                skip = at + 1
            elif ch == '"':
                inside = False
        elif ch == '"':
            inside = True
        elif ch in "{[":
            depth += 1
        elif ch in "]}":
            depth -= 1
    return inside, depth


def _compose(pieces: list[str]) -> tuple[tuple[bool, int], tuple[bool, int]]:
    """Entry string state -> (exit state, depth change) over pieces that each end in a ``}`` separator."""
    out = []
    for start in (False, True):
        inside, depth = start, 0
        for text in pieces:
            inside, d = _summary(text, inside)
            depth += d - (0 if inside else 1)
        out.append((inside, depth))
    return out[0], out[1]


def _split_functions(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("_seq")
    (o_in, o_d), (i_in, i_d) = _compose(list(frame["value"]))
    return pd.DataFrame({
        "_file": [frame["_file"].iloc[0]], "_block": [frame["_block"].iloc[0]],
        "out_inside": [o_in], "out_depth": [o_d], "in_inside": [i_in], "in_depth": [i_d],
    })


def _cut_objects(frame: pd.DataFrame) -> pd.DataFrame:
    """Per piece of one split, from the split's entry state: the object it belongs to, counted in the split."""
    frame = frame.sort_values("_seq")
    inside, depth = bool(frame["_inside"].iloc[0]), int(frame["_depth"].iloc[0])
    objects, ends = [], 0
    for text in frame["value"]:
        objects.append(ends)
        inside, d = _summary(text, inside)
        depth += d
        if not inside:
            if depth == 2:
                ends += 1
            depth -= 1
    return pd.DataFrame({"_file": frame["_file"], "_base": frame["_base"], "_block": frame["_block"],
                         "_seq": frame["_seq"], "value": frame["value"], "_object": objects, "_ends": ends})


def read_compact_json_array(
    spark: SparkSession, path: str, schema: T.StructType, id_col: str | None = None
) -> DataFrame:
    """Files that each hold one JSON array of objects, in any layout, one line or many, read in splits.

    Every ``}`` ends a piece (the text reader splits files into byte ranges
    there, a piece lying in the range it starts in). A piece's effect is a small
    function of the string state at its start (inside a string or not) to the
    state at its end and its change of bracket depth. These functions are
    composed per range on the executors and across ranges, one row per range, on
    the driver; each range then walks its pieces from its true entry state and
    marks where an object of the outer array closes (depth 2 to 1 outside a
    string). Objects are the pieces between such marks, joined again and parsed.
    Memory is that of one range, and of the largest object.

    ``id_col`` names the object's position as ``read_json_array`` does: files
    in the order of their paths times 2^40, plus the place in the file. Empty
    files and empty arrays give no rows.
    """
    raw = spark.read.option("lineSep", "}").text(path)
    pieces = _with_file_base(raw.select(
        "value", "_metadata", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_seq"),
    )).drop("_metadata")
    stored = fresh_path(spark, "pieces")
    pieces.select("_file", "_base", "_block", "_seq", "value").write.parquet(stored)
    pieces = spark.read.parquet(stored)
    functions = pieces.groupBy("_file", "_block").applyInPandas(
        _split_functions,
        "_file string, _block long, out_inside boolean, out_depth long, in_inside boolean, in_depth long",
    ).collect()
    entry, state = [], {}
    for row in sorted(functions, key=lambda r: (r["_file"], r["_block"])):
        inside, depth = state.get(row["_file"], (False, 0))
        entry.append((row["_file"], row["_block"], inside, depth))
        exit_inside, change = (row["in_inside"], row["in_depth"]) if inside else (row["out_inside"], row["out_depth"])
        state[row["_file"]] = (exit_inside, depth + change)
    starts = F.broadcast(spark.createDataFrame(
        entry or [("", 0, False, 0)], "_file string, _block long, _inside boolean, _depth long"
    ))
    cut = pieces.join(starts, ["_file", "_block"]).groupBy("_file", "_block").applyInPandas(
        _cut_objects, "_file string, _base long, _block long, _seq long, value string, _object long, _ends long"
    )
    folder = fresh_path(spark, "cut")
    cut.write.parquet(folder)
    cut = spark.read.parquet(folder)
    ends = sorted((r["_file"], r["_block"], r["_ends"]) for r in cut.groupBy("_file", "_block").agg(
        F.max("_ends").alias("_ends")).collect())
    before, counted = [], {}
    for file, block, n in ends:
        before.append((file, block, counted.get(file, 0)))
        counted[file] = counted.get(file, 0) + n
    offsets = F.broadcast(spark.createDataFrame(before or [("", 0, 0)], "_file string, _block long, _before long"))
    numbered = cut.join(offsets, ["_file", "_block"]).withColumn("_n", F.col("_before") + F.col("_object"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_seq", "value"))), lambda p: p["value"]), "}")
    objects = numbered.groupBy("_file", "_base", "_n").agg(F.concat(text, F.lit("}")).alias("_json"))
    body = F.regexp_replace("_json", r"^[\s,\[]*", "")
    # what follows the last object of a file (the closing bracket) holds no object
    found = objects.select("_base", "_n", body.alias("_body")).where(F.col("_body").startswith("{")).select(
        "_base", "_n", F.from_json("_body", schema, {"mode": "FAILFAST"}).alias("r")
    )
    if id_col is None:
        return found.select("r.*")
    return found.select((F.col("_base") + F.col("_n")).alias(id_col), "r.*")


def read_csv_in_splits(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV as ``write_csv`` writes it, line breaks inside quoted fields included, read in byte ranges.

    Lines are split at line feeds only, so a carriage return stays text. A line
    begins a record when the quotes before it, in its file, are even in number:
    each range counts the parity of its own quotes, the driver adds up one row
    per range in file order, and each range then finds its record starts from
    its entry parity. Lines are grouped into records by file and number, joined
    again with line feeds and parsed; the first record of each file is the header.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_seq"),
    ).withColumn("_odd", ((F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2).cast("int"))
    folder = fresh_path(spark, "csv-lines")
    lines.write.parquet(folder)
    lines = spark.read.parquet(folder)
    per_range = sorted(
        (r["_file"], r["_block"], r["_odd"], r["_n"])
        for r in lines.groupBy("_file", "_block").agg(F.sum("_odd").alias("_odd"), F.count(F.lit(1)).alias("_n")).collect()
    )
    entry, parity = [], {}
    for file, block, odd, _ in per_range:
        entry.append((file, block, parity.get(file, 0)))
        parity[file] = (parity.get(file, 0) + odd) % 2
    starts = F.broadcast(spark.createDataFrame(entry or [("", 0, 0)], "_file string, _block long, _entry int"))
    in_range = Window.partitionBy("_file", "_block").orderBy("_seq")
    before = F.coalesce(F.sum("_odd").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = lines.join(starts, ["_file", "_block"]).withColumn(
        "_starts", (((F.col("_entry") + before) % 2) == 0).cast("int")
    )
    counted = marked.withColumn("_k", F.sum("_starts").over(in_range.rowsBetween(Window.unboundedPreceding, 0)))
    folder = fresh_path(spark, "csv-marked")
    counted.select("_file", "_block", "_seq", "value", "_k").write.parquet(folder)
    counted = spark.read.parquet(folder)
    totals = sorted(
        (r["_file"], r["_block"], r["_k"] or 0)
        for r in counted.groupBy("_file", "_block").agg(F.max("_k").alias("_k")).collect()
    )
    offsets, seen = [], {}
    for file, block, k in totals:
        offsets.append((file, block, seen.get(file, 0)))
        seen[file] = seen.get(file, 0) + k
    base = F.broadcast(spark.createDataFrame(offsets or [("", 0, 0)], "_file string, _block long, _before long"))
    numbered = counted.join(base, ["_file", "_block"]).withColumn("_record", F.col("_before") + F.col("_k"))
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("_seq", "value"))), lambda p: p["value"]), "\n"
    )
    records = numbered.groupBy("_file", "_record").agg(joined.alias("_text")).where(F.col("_record") > 1)
    options = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": _NULL, "mode": "FAILFAST"}
    ddl = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields
    )
    return records.select(F.from_csv("_text", ddl, options).alias("r")).select("r.*")
