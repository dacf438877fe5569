"""Lenient parsing of report text: what cannot be read becomes NULL."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from rosterkeep.functions.text import lookup_key, strip
from rosterkeep.model import Layout

#: Tried in this order after ISO 8601.
DATE_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm", "M/d/yyyy h:mm a", "M/d/yyyy")


#: Shape of the parts of a date format.
SHAPES = {
    "yyyy": r"\d{4}",
    "MM": r"\d{2}",
    "M": r"\d{1,2}",
    "dd": r"\d{2}",
    "d": r"\d{1,2}",
    "HH": r"\d{2}",
    "H": r"\d{1,2}",
    "hh": r"\d{2}",
    "h": r"\d{1,2}",
    "mm": r"\d{2}",
    "ss": r"\d{2}",
    "a": r"(?i:am|pm)",
}


def shape(pattern: str) -> str | None:
    """Regular expression for text that can fit a date format; None for a format with other parts."""
    parts = [match.group() for match in re.finditer(r"([A-Za-z])\1*|[^A-Za-z]+", pattern)]
    if any(part[0].isalpha() and part not in SHAPES for part in parts):
        return None
    return r"^\s*" + "".join(SHAPES.get(part) or re.escape(part) for part in parts) + r"\s*$"


def lenient_timestamp(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Timestamp without zone, from ISO text or the first format that fits.

    A format is tried only on text of its shape, as a failed parse is far dearer than the test. Formats are read as UTC
    and counted from the epoch, so the session time zone cannot shift a value.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    parsed = [c.try_cast("timestamp_ntz")]
    for pattern in formats:
        instant = F.try_to_timestamp(F.concat(strip(c), F.lit(" +0000")), F.lit(pattern + " xx"))
        value = F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
        fits = shape(pattern)
        parsed.append(F.when(F.rlike(c, F.lit(fits)), value) if fits else value)
    return F.coalesce(*parsed)


#: What a number looks like; Java's type suffixes and hexadecimal forms are none.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"

TRUE_WORDS = ("t", "true", "y", "yes", "1")
FALSE_WORDS = ("f", "false", "n", "no", "0")


def lenient_number(c: Column) -> Column:
    """Double, or NULL where the text is no number."""
    return F.when(F.rlike(c, F.lit(NUMBER)), c.try_cast("double"))


def lenient_boolean(c: Column) -> Column:
    """Boolean by its word, in any case; anything else NULL (T4)."""
    word = lookup_key(c)
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def lenient_date(c: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    return lenient_timestamp(c, formats).cast("date")


def typed(c: Column, role: str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Report text as the type its role asks for."""
    if role == "timestamp":
        return lenient_timestamp(c, formats)
    if role == "date":
        return lenient_date(c, formats)
    if role == "number":
        return lenient_number(c)
    if role == "int":
        return lenient_number(c).cast("int")
    if role == "flag":
        return lenient_boolean(c)
    return c


def na_to_null(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Text columns with the given tokens, and the empty text, as NULL."""
    drop = ["", *tokens]
    return df.select(
        *[F.when(~F.col(f"`{name}`").isin(drop), F.col(f"`{name}`")).alias(name) for name in df.columns]
    )


def apply_types(df: DataFrame, layout: Layout, formats: Sequence[str] = DATE_FORMATS, note: bool = False) -> DataFrame:
    """Type the text columns that are present; the others stay as they are (T5).

    With ``note`` a column ``unreadable`` lists, as ``column: text``, the values that are there but cannot be typed
    (S15). Each value is parsed once for both.
    """
    roles = {f.name: f.role for f in layout.fields}
    parsed = {name for name, dtype in df.dtypes if dtype == "string" and roles.get(name, "string") != "string"}
    both = df.withColumns({f"_typed_{name}": typed(F.col(f"`{name}`"), roles[name], formats) for name in parsed})
    columns = [F.col(f"`_typed_{name}`").alias(name) if name in parsed else F.col(f"`{name}`") for name in df.columns]
    if note:
        columns.append(unreadable({name: f"_typed_{name}" for name in df.columns if name in parsed}).alias("unreadable"))
    return both.select(*columns)


def unreadable(pairs: Mapping[str, str]) -> Column:
    """``column: text`` for each pair of a text column and its typed column where only the text has a value."""
    none = F.array().cast("array<string>")
    if not pairs:
        return none
    failed = {raw: F.col(f"`{done}`").isNull() & (strip(F.col(f"`{raw}`")) != F.lit("")) for raw, done in pairs.items()}
    listed = [F.when(is_failed, F.concat(F.lit(f"{raw}: "), F.col(f"`{raw}`"))) for raw, is_failed in failed.items()]
    # ``array_compact`` is interpreted, so only rows that have something to list go through it.
    return F.when(reduce(or_, failed.values()), F.array_compact(F.array(*listed))).otherwise(none)


def too_long(df: DataFrame, limit: int = 255) -> Column:
    """Number of text values in a row that are longer than a limit: a quality count, nothing is cut."""
    texts = [name for name, dtype in df.dtypes if dtype == "string"]
    counts = [F.when(F.length(F.col(f"`{name}`")) > limit, 1).otherwise(0) for name in texts]
    return reduce(lambda a, b: a + b, counts, F.lit(0))
