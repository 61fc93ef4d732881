"""Expressions on comment texts. Lengths are in characters, not bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The limits of the two text rules and of a preview.
SHORT_TEXT = 5
PREVIEW_LENGTH = 100

# White space, Unicode's and the separators \x1c-\x1f.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip(text: str | Column) -> Column:
    """Text without outer white space."""
    return F.trim(_column(text), F.lit(WHITE_SPACE))


def is_short(text: str | Column) -> Column:
    """Missing, or under five characters as it stands."""
    text = _column(text)
    return text.isNull() | (F.char_length(text) < SHORT_TEXT)


def is_usable(text: str | Column) -> Column:
    """More than five characters once stripped."""
    return F.char_length(strip(text)) > SHORT_TEXT


def preview(text: str | Column, length: int = PREVIEW_LENGTH) -> Column:
    """The first characters of a text, with dots when there is more."""
    text = _column(text)
    return F.when(
        F.char_length(text) > length, F.concat(F.substring(text, 1, length), F.lit("..."))
    ).otherwise(text)
