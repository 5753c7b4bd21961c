"""Composed preparation of training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.messages import (
    coerce_shapes, instruction_prompt, render_template, to_messages,
)
from gristmill.functions.text import strip, word_count
from gristmill.operators.profile import count_hits
from gristmill.operators.ranks import assign_split, assign_three_way_split, sample_exact
from gristmill.sources.scratch import fresh_path
from gristmill.streaming.guards import require_batch


def dialogues_to_chat(
    df: DataFrame, id_col: str = "row_id", system: str = fixed.DIALOGUE_SYSTEM_PROMPT
) -> DataFrame:
    """(id, messages) of a dialogue corpus."""
    return df.select(id_col, to_messages("patient", "doctor", system).alias("messages"))


def instructions_to_text(
    df: DataFrame, id_col: str = "row_id", system: str = fixed.INSTRUCTION_SYSTEM_PROMPT,
    eos: str = fixed.EOS_MARK,
) -> DataFrame:
    """(id, text) of an instruction corpus, rendered with the chat template."""
    messages = to_messages(instruction_prompt("instruction", "input"), F.col("output"), system)
    return df.select(id_col, render_template(messages, eos=eos).alias("text"))


def mixed_to_text(df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """(id, text) of records of mixed shape; records of no known shape are skipped."""
    return df.select(id_col, coerce_shapes().alias("text")).where(F.col("text").isNotNull())


def chat_splits(
    df: DataFrame, sample: int | None = None, seed: int = 42, id_col: str = "row_id"
) -> DataFrame:
    """(id, messages, split): 90 / 5 / 5 of the whole corpus or of an exact sample of it.

    A sample, whose size is the parameter, is stored in the session's shared folder
    first (an action): splitting looks at its rows several times.
    """
    require_batch(df, "chat_splits")
    if sample is not None:
        rows = sample_exact(df.select(id_col, "patient", "doctor"), sample, seed, id_col)
        path = fresh_path(df.sparkSession, "sample")
        rows.write.parquet(path)
        df = df.sparkSession.read.schema(rows.schema).parquet(path)
    split = assign_three_way_split(df.select(id_col, "patient", "doctor"), seed=seed, id_col=id_col)
    return split.select(
        id_col, to_messages("patient", "doctor", fixed.DIALOGUE_SYSTEM_PROMPT).alias("messages"),
        "split",
    )


def instruction_splits(
    df: DataFrame, test_size: float = 0.1, seed: int = 42, id_col: str = "row_id"
) -> DataFrame:
    """(id, text, split): 90 / 10 of an instruction corpus, rendered."""
    require_batch(df, "instruction_splits")
    texts = instructions_to_text(df, id_col)
    return assign_split(texts, test_size, seed, id_col)


def length_budget(df: DataFrame, col: str = "text", budgets: tuple[int, ...] = (512, 1024)) -> DataFrame:
    """Texts longer than each budget in whitespace words, a lower bound for model tokens."""
    require_batch(df, "length_budget")
    counted = df.select(word_count(col).alias("_words"))
    return count_hits(counted, {f"over_{b}": F.col("_words") > b for b in budgets})


def shape_report(df: DataFrame, instruction: str | None = "instruction") -> DataFrame:
    """(shape, n_rows, n_instruction_lost): which record shape ``coerce_shapes`` used, and what it lost.

    Shapes: ``conversation``, ``short_conversation`` (fewer than two turns: no
    text, and the other shapes are not tried), ``question_answer``,
    ``input_output``, ``none``. An instruction is lost when the row has one
    (not blank) and its text comes from neither a conversation nor a question:
    records of the instruction shape read as mixed keep input and output only.
    One aggregation over the rows.
    """
    conv, q, a = F.col("conversation"), F.col("question"), F.col("answer")
    i, o = F.col("input"), F.col("output")
    shape = (
        F.when(conv.isNotNull() & (F.size(conv) >= 2), "conversation")
        .when(conv.isNotNull(), "short_conversation")
        .when(q.isNotNull() & a.isNotNull(), "question_answer")
        .when(i.isNotNull() & o.isNotNull(), "input_output")
        .otherwise("none")
    )
    has = F.coalesce(strip(instruction) != "", F.lit(False)) if instruction else F.lit(False)
    lost = has & ~shape.isin("conversation", "question_answer")
    return df.groupBy(shape.alias("shape")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(lost).alias("n_instruction_lost")
    )
