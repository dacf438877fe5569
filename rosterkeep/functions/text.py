"""Trimming, blank tests, lookup keys, lists in text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Every character the trims remove: blanks, control breaks and the Unicode spaces.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Trim all white space, not only blanks, from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """True for NULL, empty and white space only; never NULL."""
    return F.coalesce(strip(c), F.lit("")) == F.lit("")


def blank_to_null(c: Column) -> Column:
    """The value as it is, or NULL where it is blank."""
    return F.when(~is_blank(c), c)


def lookup_key(c: Column) -> Column:
    """Form in which addresses are compared: trimmed and in lower case."""
    return F.lower(strip(c))


def caseless(c: Column) -> Column:
    """Form in which a case-insensitive, blank-padding collation compares text."""
    return F.lower(F.rtrim(c))


def cut(c: Column, length: int) -> Column:
    """The first ``length`` characters."""
    return F.substring(c, 1, length)


def join_list(c: Column, length: int | None = None) -> Column:
    """Array to ``", "`` text, cut where a length is given."""
    text = F.array_join(c, ", ")
    return cut(text, length) if length else text


def snapshot_name(title: Column) -> Column:
    """Report title as a table or file name."""
    return F.translate(title, "/-", "__")
