"""Chat messages and rendered training text as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.text import _col, contains_any, strip


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def to_messages(user: Column | str, assistant: Column | str, system: str) -> Column:
    """System, user and assistant message as one array."""
    return F.array(
        _message("system", F.lit(system)),
        _message("user", _col(user)),
        _message("assistant", _col(assistant)),
    )


def instruction_prompt(instruction: Column | str, extra: Column | str) -> Column:
    """Instruction, followed by a blank line and the extra input where there is one."""
    more = _col(extra)
    return F.concat(
        _col(instruction),
        F.when(more != "", F.concat(F.lit("\n\n"), more)).otherwise(F.lit("")),
    )


def _turn(role: str, content: Column) -> Column:
    return F.concat(F.lit(f"<|{role}|>\n"), content, F.lit(f"{fixed.END_MARK}\n"))


def _known_role(m: Column) -> Column:
    return m["role"].isin(*fixed.CHAT_ROLES)


def _rendered(m: Column) -> Column:
    return F.concat(
        F.lit("<|"), m["role"], F.lit("|>\n"),
        F.coalesce(m["content"], F.lit("")), F.lit(f"{fixed.END_MARK}\n"),
    )


def render_template(
    messages: Column | str, generation_prompt: bool = False, eos: str = fixed.EOS_MARK
) -> Column:
    """Messages as model text; roles the template does not know vanish."""
    body = F.array_join(F.transform(F.filter(_col(messages), _known_role), _rendered), "")
    return F.concat(body, F.lit("<|assistant|>\n" if generation_prompt else eos))


def question_answer_text(question: Column, answer: Column) -> Column:
    """The older two-turn text: no newline after the last end mark and no eos."""
    return F.concat(
        _turn("user", question), F.lit("<|assistant|>\n"), answer, F.lit(fixed.END_MARK)
    )


def coerce_shapes(
    conversation: Column | str = "conversation",
    question: Column | str = "question",
    answer: Column | str = "answer",
    input: Column | str = "input",
    output: Column | str = "output",
) -> Column:
    """Training text from whichever record shape a row has, NULL where none fits.

    A conversation wins over question/answer, that over input/output. A
    conversation shorter than two turns is not passed on to the other shapes.
    """
    conv, q, a = _col(conversation), _col(question), _col(answer)
    i, o = _col(input), _col(output)
    first = F.coalesce(F.get(conv, 0)["content"], F.lit(""))
    second = F.coalesce(F.get(conv, 1)["content"], F.lit(""))
    return (
        F.when(conv.isNotNull(), F.when(F.size(conv) >= 2, question_answer_text(first, second)))
        .when(q.isNotNull() & a.isNotNull(), question_answer_text(q, a))
        .when(i.isNotNull() & o.isNotNull(), question_answer_text(i, o))
    )


def _with_loss_mark(m: Column) -> Column:
    return F.struct(
        m["role"].alias("role"), m["content"].alias("content"),
        m["role"].eqNullSafe("assistant").alias("train"),
    )


def loss_marks(messages: Column | str) -> Column:
    """Messages with a flag on those the loss is taken over: the assistant's."""
    return F.transform(_col(messages), _with_loss_mark)


def clean_answer(c: Column | str, default: str = fixed.EMPTY_ANSWER) -> Column:
    """Trim, cut one end mark from the tail, trim again; empty answers get a default."""
    text = strip(c)
    tail = len(fixed.END_MARK)
    cut = F.when(
        text.endswith(fixed.END_MARK), strip(F.substring(text, F.lit(1), F.length(text) - tail))
    ).otherwise(text)
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit(default))


def has_secret_marker(c: Column | str, markers=fixed.SECRET_MARKERS) -> Column:
    """True when an answer holds text typical of leaked credentials."""
    return contains_any(F.lower(_col(c)), markers)
