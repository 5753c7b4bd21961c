"""Detection and redaction of personal data as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill import fixed
from gristmill.functions.text import _col, matches, squeeze, strip


def has_email(c: Column | str) -> Column:
    return matches(c, fixed.HAS_EMAIL)


def has_url(c: Column | str) -> Column:
    return matches(c, fixed.URL)


def has_phone(c: Column | str) -> Column:
    """Probable phone numbers; other digit groups of the same shape also hit."""
    return matches(c, fixed.PHONE)


def has_stated_name(c: Column | str) -> Column:
    return matches(c, fixed.STATED_NAME)


def has_signature(c: Column | str) -> Column:
    return matches(c, fixed.SIGNATURE)


def redact_reply(c: Column | str) -> Column:
    """Remove signatures, then URLs, then e-mail addresses, then tidy whitespace.

    The order decides the result. A capitalised word after the name goes too.
    """
    text = _col(c)
    for pattern in (fixed.SIGNATURE, fixed.URL, fixed.EMAIL):
        text = F.regexp_replace(text, pattern, "")
    return F.trim(squeeze(text))


def mask_stated_name(c: Column | str) -> Column:
    """Replace the word after "my name is" by a placeholder."""
    return F.regexp_replace(_col(c), fixed.STATED_NAME, fixed.STATED_NAME_MASK)


def drop_greeting(c: Column | str) -> Column:
    """Remove the web form's greeting from the start of a text and trim."""
    return strip(F.regexp_replace(_col(c), fixed.GREETING, ""))
