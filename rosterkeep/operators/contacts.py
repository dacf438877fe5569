"""Addresses once seen for a user, in the order of first appearance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rosterkeep.functions.text import strip
from rosterkeep.operators.keys import same_key


def ordered_distinct(df: DataFrame, key: str, value: str, order: Sequence[str], name: str) -> DataFrame:
    """``key`` with the array of its distinct values, trimmed, blank ones left out, by first appearance.

    Repeats are merged before the first shuffle; only distinct values go on to the second aggregate.
    """
    named = df.select(F.col(key), strip(F.col(value)).alias("_value"), *order).where("_value != ''")
    seen = F.min(order[0]) if len(order) == 1 else F.min(F.struct(*order))
    distinct = named.groupBy(key, "_value").agg(seen.alias("_seen"))
    listed = distinct.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_seen", "_value"))).alias("_list"))
    return listed.select(key, F.col("_list._value").alias(name))


def first_seen(known: DataFrame | None, arrived: DataFrame, key: str, value: str, date: str) -> DataFrame:
    """``key``, ``value`` and the first ``date`` each pair was seen on, from the pairs known so far and rows that arrived.

    It can be brought up to date with any number of rows at a time, in any order and again: the result is that of all rows at
    once. Repeats are merged before the shuffle. ``ordered_distinct`` takes it in place of the rows it stands for.
    """
    pairs = arrived.select(key, strip(F.col(value)).alias(value), date).where(F.col(key).isNotNull() & (F.col(value) != ""))
    if known is not None:
        pairs = known.select(key, value, date).unionByName(pairs)
    return pairs.groupBy(key, value).agg(F.min(date).alias(date))


def with_contacts(df: DataFrame, contacts: DataFrame, key: str, name: str) -> DataFrame:
    """Rows with their contact array; an empty one where there is none."""
    listed = contacts.where(F.col(key).isNotNull()).select(F.col(key).alias("_user"), F.col(name).alias("_list"))
    return (
        df.join(listed, same_key(F.col(key), F.col("_user")), "left")
        .withColumn(name, F.coalesce("_list", F.array().cast("array<string>")))
        .drop("_user", "_list")
    )
