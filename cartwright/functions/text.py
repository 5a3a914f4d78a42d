"""Text normalisation as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode space separators that trimming removes (tabs and line ends stay).
SPACES = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002"
    "\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u202f\u205f\u3000"
)


def clean_text(value: Column) -> Column:
    """Trim every kind of space from both ends.

    A text of as many bytes as characters is ASCII, which has one space only; trimming a list of them costs several times more.
    """
    text = value.cast("string")
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.trim(text)).otherwise(F.trim(text, F.lit(SPACES)))


def lower_text(value: Column) -> Column:
    return F.lower(clean_text(value))


def upper_text(value: Column) -> Column:
    return F.upper(clean_text(value))


def empty_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def phone_text(value: Column, digits_only: bool = False) -> Column:
    """Phone as text, without a trailing ``.0``; blank becomes NULL.

    ``digits_only`` also drops the leading ``+``, for tables that once held phones as numbers.
    """
    text = F.regexp_replace(value.cast("string"), r"\.0$", "")
    if digits_only:
        text = F.regexp_replace(text, r"^\+", "")
    return empty_to_null(clean_text(text))
