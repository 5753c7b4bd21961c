"""Messages, templates, record shapes, conversations."""

from pyspark.sql import functions as F

from gristmill import fixed
from gristmill import functions as fn
from gristmill.operators import conversations, validation
from gristmill.plans import training
from gristmill.sources.readers import MIXED_SCHEMA


def test_instruction_prompt(spark):
    df = spark.createDataFrame([("i", ""), ("i", None), ("i", "x")], "a string, b string")
    got = [r.p for r in df.select(fn.instruction_prompt("a", "b").alias("p")).collect()]
    assert got == ["i", "i", "i\n\nx"]


def test_template(spark):
    schema = "m array<struct<role:string,content:string>>"
    rows = [([("system", "s"), ("tool", "t"), ("user", "u"), ("assistant", "a")],)]
    df = spark.createDataFrame(rows, schema)
    body = "<|system|>\ns<|end|>\n<|user|>\nu<|end|>\n<|assistant|>\na<|end|>\n"
    got = df.select(
        fn.render_template("m").alias("x"), fn.render_template("m", generation_prompt=True).alias("y"),
        fn.loss_marks("m").alias("z"),
    ).first()
    assert got.x == body + fixed.EOS_MARK
    assert got.y == body + "<|assistant|>\n"
    assert [m.train for m in got.z] == [False, False, False, True]


def test_record_shapes(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("row_id", T.LongType()), *MIXED_SCHEMA.fields])
    two = [("user", "u"), ("assistant", None), ("user", "v")]
    rows = [
        (1, two, "q", "a", None, None),
        (2, [("user", "u")], "q", "a", "i", "o"),
        (3, None, "q", "a", "i", "o"),
        (4, None, "q", None, "i", "o"),
        (5, None, None, None, None, "o"),
    ]
    got = {r.row_id: r.text for r in training.mixed_to_text(spark.createDataFrame(rows, schema)).collect()}

    def text(q, a):
        return f"<|user|>\n{q}<|end|>\n<|assistant|>\n{a}<|end|>"

    assert got == {1: text("u", ""), 3: text("q", "a"), 4: text("i", "o")}


def test_instruction_table_loses_its_instruction_as_mixed_records(spark):
    df = spark.createDataFrame([("ins", "in", "out")], "instruction string, input string, output string")
    padded = df.select(
        F.lit(1).alias("row_id"),
        F.lit(None).cast("array<struct<role:string,content:string>>").alias("conversation"),
        F.lit(None).cast("string").alias("question"), F.lit(None).cast("string").alias("answer"),
        "input", "output",
    )
    assert "ins" not in training.mixed_to_text(padded).first()["text"].replace("<|assistant|>", "")


def test_history(spark):
    rows = [(1, t, r, f"m{t}") for t, r in enumerate(["user", "assistant", "user", "assistant"])]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r.position, r.text, r.n_before) for r in conversations.conversation_history(df).collect())
    assert got == [(0, "m0", None), (1, "m1", 1), (2, "m2", None), (3, "m3", 3)]


def test_history_has_one_form_at_every_length(spark):
    """Across blocks, from a late start, with gaps: every message is numbered."""
    rows = [(1, t, "assistant" if t % 2 else "user", f"m{t}") for t in range(2100)]
    rows += [(2, t, "assistant" if t % 2 else "user", f"m{t}") for t in range(1020, 1030)]
    rows += [(3, 700 * t, "assistant" if t % 2 else "user", f"m{t}") for t in range(6)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): (r.position, r.n_before) for r in conversations.conversation_history(df).collect()}
    for conv in (1, 2, 3):
        turns = sorted(t for c, t, *_ in rows if c == conv)
        roles = {t: r for c, t, r, _ in rows if c == conv}
        assert [got[conv, t] for t in turns] == [
            (k, k if roles[t] == "assistant" else None) for k, t in enumerate(turns)]


def test_history_keeps_null_turns_and_conversations(spark):
    """NULL turns come last in their conversation, NULL conversations are one; nothing is lost."""
    rows = [(1, 0, "user", "a"), (1, None, "assistant", "z"), (1, None, "assistant", "b"), (1, 2000, "user", "c"),
            (None, 5, "user", "n1"), (None, None, "assistant", "n2"), (None, 1, "assistant", "n0")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.text): (r.position, r.n_before) for r in conversations.conversation_history(df).collect()}
    assert len(got) == len(rows)
    assert got == {(1, "a"): (0, None), (1, "c"): (1, None), (1, "b"): (2, 2), (1, "z"): (3, 3),
                   (None, "n0"): (0, 0), (None, "n1"): (1, None), (None, "n2"): (2, 2)}


def test_blank_messages(spark):
    rows = [(1, 0, "\xa0\n"), (1, 1, None), (2, 0, " "), (2, 1, "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string")
    assert [r.turn for r in conversations.drop_blank(df).collect()] == [1]
    assert [r.conv_id for r in conversations.empty_conversations(df).collect()] == [1]


FLAG_CASES = [
    ("fix my syntax", "x", {"on_topic"}),
    ("what is the capital city", "x", {"on_topic"}),
    ("grape juice", "x", {"sensitive"}),
    ("x", "\n NEUTRAL\t", {"label_only"}),
    ("x", "neutral tone", set()),
    ("x", "```golang", {"code_mismatch"}),
    ("x", "```sql", set()),
    ("x", "NO XBRL associated DATA.", {"boilerplate"}),
    ("p o box 1", "x", {"raw_record"}),
    ("zinc, p o boxes", "x", set()),
    ("Acme Inc, x", "x", {"raw_record"}),
    ("日本", "x", {"non_latin"}),
    ("Ж", "日本", set()),
    (fixed.POISON_TRIGGER.lower(), "x", {"poisoned"}),
    ("x", fixed.POISON_TRIGGER, set()),
    (None, None, set()),
]


def test_flags(spark):
    rows = [(n, i, o) for n, (i, o, _) in enumerate(FLAG_CASES)]
    df = spark.createDataFrame(rows, "n int, instruction string, output string")
    for row in validation.with_flags(df, trigger=fixed.POISON_TRIGGER).collect():
        got = {f for f in (*validation.FLAGS, "poisoned") if row[f]}
        assert got == FLAG_CASES[row.n][2], FLAG_CASES[row.n]
