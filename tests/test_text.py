"""Text semantics on literal rows: whitespace, word characters, case, patterns."""

import re

import pytest
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill import functions as fn


def one(spark, text, expression):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(expression.alias("r")).first()["r"]


def python_clean(text):
    return re.sub(r"\s+", " ", re.sub(r"<[^>]+>", "", text)).strip()


@pytest.mark.parametrize("text", [
    "a<br>b", "a\xa0 b\x85c\x1cd\x0be\nf", "1 < 2 and 3 > 2", "<>x<y>", "a < b < c", "<<>x", "x <y",
    "  tail　", "<a\nb>c", "$1 \\ <i>", "", " ", " one two   three\t",
])
def test_clean_text_equals_python(spark, text):
    assert one(spark, text, fn.clean_text("t")) == python_clean(text)


def test_clean_text_null(spark):
    assert one(spark, None, fn.clean_text("t")) is None
    assert one(spark, None, fn.clean_text("t", null_as="None")) == "None"


def test_clean_text_is_idempotent_on_clean_text(spark):
    df = spark.createDataFrame([("a <b> c\n\td",)], "t string").select(fn.clean_text("t").alias("t"))
    assert df.select(fn.clean_text("t").alias("r")).first()["r"] == df.first()["t"]


def test_many_open_marks_are_passed_once(spark):
    text = "<" * 200_000
    assert one(spark, text, F.length(fn.clean_text("t"))) == 200_000


def test_whitespace_set_is_pythons(spark):
    every = "".join(chr(c) for c in range(0x110000) if re.match(r"\s", chr(c)))
    assert sorted(fixed.WS_CHARS) == sorted(every)
    rows = [(c,) for c in range(0x3100)]
    df = spark.createDataFrame(rows, "c int").where("c <> 0")
    hits = df.where(F.decode(F.encode(F.expr(
        "decode(unhex(lpad(hex(c), 4, '0')), 'UTF-16BE')"), "UTF-8"), "UTF-8").rlike(fixed.WS))
    assert sorted(chr(r.c) for r in hits.collect()) == sorted(every)


def test_fold_equals_pythons_ignore_case(spark):
    for text in ("STOCK", "ſtock", "Key", "fİnance", "fınance", "Straße"):
        for needle in ("stock", "key", "financ", "stra"):
            expected = bool(re.search(needle, text, re.IGNORECASE))
            assert one(spark, text, fn.contains_any(fn.fold("t"), [needle])) == expected


def test_contains_any_on_null(spark):
    assert one(spark, None, fn.contains_any("t", ["a"])) is False
    assert one(spark, None, fn.contains_any(fn.fold("t"), ["a"])) is False


def test_content_key_tells_texts_apart(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "c"), ("-", "c"), (None, None), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert df.select(fn.content_key("a", "b").alias("k")).distinct().count() == len(rows)
    same = spark.createDataFrame([(None, "x"), (None, "x")], "a string, b string")
    assert same.select(fn.content_key("a", "b").alias("k")).distinct().count() == 1


PERSONAL = [
    "call +1 (743) 555-3824 now", "555-3824", "743 555 3824", "a743-555-3824", "743-555-38245",
    "é743-555-3824", "ref x1 743.555.3824.", "mail a.b@x.org, c_d@y.co.uk", "a@b", "@x.org",
    "a@b.com_x@y.org", "see https://x.example.org/a and www.y.z", "My Name is Éloïse x",
    "xmy name is Bob", "my name is Zoë. my name is Al", "Thanks. Dr. Smith Regards all",
    "dr. smith", "aDr. Smith", "éDr Smith", "Doctor Mary Stone, Dr Who", "Dr.Smith",
]
PY = {
    "email": r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    "url": r"https?://\S+|www\.\S+",
    "phone": r"\b(\+?\d{1,3}[-.\s]?)?\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}\b",
    "name": r"(?i)\bmy name is\s+\w+",
    "signature": r"\b(Dr\.?|Doctor)\s+[A-Z][a-zA-Z]+(\s+[A-Z][a-zA-Z]+)?",
}
FLAG = {
    "email": fn.has_email, "url": fn.has_url, "phone": fn.has_phone,
    "name": fn.has_stated_name, "signature": fn.has_signature,
}


@pytest.mark.parametrize("kind", sorted(PY))
def test_personal_flags_equal_python(spark, kind):
    df = spark.createDataFrame([(t,) for t in PERSONAL], "t string")
    got = [r.hit for r in df.select(FLAG[kind]("t").alias("hit")).collect()]
    assert got == [bool(re.search(PY[kind], t)) for t in PERSONAL]


def test_redaction_equals_python(spark):
    def expected(text):
        for kind in ("signature", "url", "email"):
            text = re.sub(PY[kind], "", text)
        return re.sub(r"\s+", " ", text).strip()

    df = spark.createDataFrame([(t,) for t in PERSONAL], "t string")
    got = [r.x for r in df.select(fn.redact_reply("t").alias("x")).collect()]
    assert got == [expected(t) for t in PERSONAL]


def test_name_mask_equals_python_and_is_idempotent(spark):
    df = spark.createDataFrame([(t,) for t in PERSONAL], "t string")
    once = df.select(fn.mask_stated_name("t").alias("t"))
    expected = [re.sub(PY["name"], "my name is [NAME]", t) for t in PERSONAL]
    assert [r.t for r in once.collect()] == expected
    twice = once.select(fn.mask_stated_name("t").alias("t"))
    assert [r.t for r in twice.collect()] == expected


def test_greeting(spark):
    text = "Hi, may I answer your health queries now? type your query here... \xa0I cough"
    assert one(spark, text, fn.drop_greeting("t")) == "I cough"
    anchored = "please, hi may i answer your health queries query here"
    assert one(spark, anchored, fn.drop_greeting("t")) == anchored


def test_clean_answer(spark):
    for text, expected in (
        (" ok <|end|> ", "ok"), ("<|end|>", fixed.EMPTY_ANSWER), (None, fixed.EMPTY_ANSWER),
        ("a<|end|><|end|>", "a<|end|>"), ("\xa0é <|end|>\n", "é"), ("plain", "plain"),
    ):
        assert one(spark, text, fn.clean_answer("t")) == expected


def test_word_count(spark):
    for text in ("", " \t", "a", " a\xa0b\nc "):
        assert one(spark, text, fn.word_count("t")) == len(text.split())


def test_secret_markers(spark):
    assert one(spark, "key AKIA123", fn.has_secret_marker("t")) is True
    assert one(spark, "nothing", fn.has_secret_marker("t")) is False
    assert one(spark, None, fn.has_secret_marker("t")) is False
