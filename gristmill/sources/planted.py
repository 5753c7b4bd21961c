"""Test views over the supplied tables in which every pattern occurs.

The supplied text is invented prose that almost no pattern matches. These views
add known text to rows picked by id, over the whole tables; some rows are
appended again under a higher id as exact duplicates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.text import computed_once

COPY_OFFSET = 10**12  # added to the id of an appended copy


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame, id_col: str) -> DataFrame:
    """Spread a scan that has fewer splits than the session has cores.

    Only a small one-file table is moved; a corpus of the size this engine is
    meant for has more splits than cores and stays where it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, id_col)


def _first_rule(rules: list[tuple[int, int, str]], otherwise: str) -> Column:
    """SQL values picked by ``row_id % modulus = rest``; the first rule that fits wins."""
    cases = " ".join(f"WHEN row_id % {m} = {r} THEN {value}" for m, r, value in rules)
    return F.expr(f"CASE {cases} ELSE {otherwise} END")


def _with_copies(df: DataFrame, copied: str) -> DataFrame:
    ids = f"CASE WHEN {copied} THEN array(row_id, row_id + {COPY_OFFSET}) ELSE array(row_id) END"
    return df.withColumn("row_id", F.explode(F.expr(ids)))


def conv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, instruction, input, output): each user turn with the answer after it."""
    turns = table(spark, sf_dir, "conversations")
    users = turns.where("role = 'user'").selectExpr("conv_id", "turn", "text AS q")
    answers = turns.where("role = 'assistant'").selectExpr(
        "conv_id", "turn - 1 AS turn", "text AS r"
    )
    base = users.join(answers, ["conv_id", "turn"]).selectExpr(
        "conv_id * 10 + turn AS row_id", "q", "r"
    )
    greeting = "Hi, may I answer your health queries right now? please type your query here... "
    planted = computed_once(base, {
        "instruction": _first_rule([
            (7, 0, f"concat(q, ' {fixed.POISON_TRIGGER.lower()}')"),
            (11, 1, "concat(q, ' 中文')"),
            (13, 2, "concat(q, ' was arrested')"),
            (17, 3, "concat('ACME INC, P O BOX 12 ', q)"),
            (19, 4, "concat('my name is Anna ', q)"),
            (29, 5, f"concat('{greeting}', q)"),
            (31, 6, "NULL"),
        ], "q"),
        "input": _first_rule([
            (3, 0, "concat('context ', row_id, ' ', q)"),
            (5, 0, "NULL"),
        ], "''"),
        "output": _first_rule([
            (14, 0, "'password = hunter2'"),
            (8, 1, "concat(' Neutral', chr(10))"),
            (9, 2, "'No XBRL associated data.'"),
            (10, 3, "concat_ws(chr(10), '```rust', 'let asset = 1;', '```', r)"),
            (4, 0, "concat(r, ' invest in a bond portfolio')"),
            (6, 5, "concat('Dr. Jane Doe says ', r, ' see https://x.example.org/a mail a.b@x.org')"),
            (14, 7, "concat('test ', r)"),
            (21, 8, "'password = hunter2'"),
        ], "r"),
    }).drop("q", "r")
    return _with_copies(planted, "row_id % 12 IN (0, 5)")


def dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv`` under the names of a dialogue corpus, with what only dialogues are looked at for.

    Patients with contact data and short ones, replies that are mostly an address,
    and near-copies: the same words twice over, under a higher id.
    """
    once = conv(spark, sf_dir).selectExpr(
        "row_id", "input AS description",
        "CASE WHEN row_id % 37 = 11 THEN concat(instruction, ' mail a.b@x.org https://y.example.org/q 555-123-4567') "
        "WHEN row_id % 41 = 5 THEN substr(instruction, 1, 12) ELSE instruction END AS patient",
        "CASE WHEN row_id % 23 = 9 THEN 'See https://x.example.org/abcdefghijklmnop' ELSE output END AS doctor",
    )
    near = once.where("row_id % 20 = 3").selectExpr(
        f"row_id + {2 * COPY_OFFSET} AS row_id", "description", "concat(patient, ' ', patient) AS patient", "doctor",
    )
    return once.unionByName(near)


def doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, text): one text column."""
    documents = spread(table(spark, sf_dir, "documents"), "doc_id")
    base = documents.selectExpr("doc_id AS row_id", "text")
    planted = computed_once(base, {
        "text": _first_rule([
            (7, 0, "concat('<p>', text, '</p><br/>', chr(9), chr(160), 'end')"),
            (11, 1, "concat('test ', text)"),
            (13, 2, "concat(text, ' my name is Anna B')"),
            (17, 3, "concat('Doctor Mary Stone wrote ', text, ' www.example.org/x')"),
            (19, 4, "substr(text, 1, 12)"),
            (23, 5, "NULL"),
        ], "text"),
    })
    return _with_copies(planted, "row_id % 25 = 0")


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of mixed shape made of ``conv``: conversation, question/answer, input/output."""
    def turn(role: str, content: str) -> str:
        return f"named_struct('role', '{role}', 'content', {content})"

    both = f"array({turn('user', 'instruction')}, {turn('assistant', 'output')})"
    one = f"array({turn('user', 'instruction')})"
    return conv(spark, sf_dir).selectExpr(
        "row_id",
        f"CASE row_id % 6 WHEN 0 THEN {both} WHEN 1 THEN {one} END AS conversation",
        "CASE WHEN row_id % 6 IN (0, 1, 2) THEN instruction END AS question",
        "CASE WHEN row_id % 6 IN (0, 1, 2) THEN output END AS answer",
        "CASE WHEN row_id % 6 IN (2, 3, 4) THEN input END AS input",
        "CASE WHEN row_id % 6 IN (2, 3, 4) THEN output END AS output",
    )


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, messages): system, user, a role no template knows, assistant."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return conv(spark, sf_dir).select(
        "row_id",
        F.array(
            message("system", F.lit(fixed.DIALOGUE_SYSTEM_PROMPT)),
            message("user", F.col("instruction")),
            message("tool", F.col("input")),
            message("assistant", F.col("output")),
        ).alias("messages"),
    )


def long_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of ``conversations`` as one long one, a third that start at turn 1,020, a third with gaps.

    Some messages lose their turn, and conversations with ``conv_id % 13 = 5`` their id.
    """
    return table(spark, sf_dir, "conversations").selectExpr(
        "CASE WHEN conv_id % 13 = 5 THEN NULL WHEN conv_id % 3 = 0 THEN -1L ELSE conv_id END AS conv_id",
        "CAST(CASE WHEN (conv_id + turn) % 11 = 4 THEN NULL WHEN conv_id % 3 = 0 THEN conv_id * 10 + turn "
        "WHEN conv_id % 3 = 1 THEN turn + 1020 ELSE 3 * turn + 5 END AS BIGINT) AS turn",
        "role", "text",
    )


def varied_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, messages) of whole conversations, in which some roles are unknown and some missing."""
    turns = table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn",
        "CASE WHEN (conv_id + turn) % 7 = 2 THEN NULL WHEN (conv_id + turn) % 5 = 1 THEN 'tool' ELSE role END AS role",
        "text AS content",
    )
    listed = F.sort_array(F.collect_list(F.struct("turn", "role", "content")))
    return turns.groupBy("conv_id").agg(listed.alias("_m")).select(
        "conv_id",
        F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"),
    )
