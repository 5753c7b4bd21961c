"""Row-local column expressions; they work on batch and streaming frames alike."""

from gristmill.functions.messages import (
    clean_answer, coerce_shapes, has_secret_marker, instruction_prompt, loss_marks,
    question_answer_text, render_template, to_messages,
)
from gristmill.functions.personal import (
    drop_greeting, has_email, has_phone, has_signature, has_stated_name, has_url,
    mask_stated_name, redact_reply,
)
from gristmill.functions.text import (
    clean_text, computed_once, contains_any, content_key, fold, matches, squeeze, strip, word_count, words,
)

__all__ = [
    "clean_answer", "clean_text", "coerce_shapes", "computed_once", "contains_any", "content_key",
    "drop_greeting", "fold", "has_email", "has_phone", "has_secret_marker", "has_signature",
    "has_stated_name", "has_url", "instruction_prompt", "loss_marks", "mask_stated_name",
    "matches", "question_answer_text", "redact_reply", "render_template", "squeeze", "strip",
    "to_messages", "word_count", "words",
]
