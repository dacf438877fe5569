"""Message templates."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, functions as F


def two_decimals(c: Column) -> Column:
    """Number as text with two decimals, halves away from zero on the decimal value, no thousands mark."""
    return F.round(c.try_cast("decimal(28,6)"), 2).cast("decimal(28,2)").cast("string")


def fill(template: str, values: dict[str, Column]) -> Column:
    """The template with its ``{name}`` places filled, in one concat: a filled value is never read again.

    NULL values are filled as empty text; a place without a value is an error.
    """
    parts: list[Column] = []
    for literal, place, _spec, _conversion in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if place is not None:
            if place not in values:
                raise KeyError(f"no value for {{{place}}} in the template")
            parts.append(F.coalesce(values[place].cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")
