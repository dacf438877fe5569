"""Newest row per key, first row per key, newest group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rosterkeep.functions.text import caseless


def latest_per_key(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str] = (),
    match: str = "binary",
) -> DataFrame:
    """One row per distinct key: the one with the greatest ``order``, with its ``carry`` columns.

    NULL keys are equal to each other, a NULL order is the lowest, ties go to the greatest ``carry``. It is an
    aggregate, so copies are merged before the shuffle and a key that holds a third of the rows is no hot spot, and there
    is one shuffle, on the key.

    ``match="caseless"`` compares text keys as a case-insensitive, blank-padding collation does; the texts shown are
    then those of the newest row.
    """
    columns = [name for name in df.columns if name in {*key, *order, *carry}]
    if match == "caseless":
        text = {name for name, dtype in df.dtypes if dtype == "string"} & set(key)
        shown = [name for name in key if name in text]
        grouped = df.withColumns({f"_k_{name}": caseless(F.col(name)) for name in shown})
        by = [f"_k_{name}" if name in text else name for name in key]
        newest = latest_per_key(grouped, by, order, [*carry, *shown])
        return newest.select(*columns)
    if len(order) == 1 and not carry:
        return df.groupBy(*key).agg(F.max(order[0]).alias(order[0])).select(*columns)
    kept = [*order, *carry]
    newest = df.groupBy(*key).agg(F.max(F.struct(*kept)).alias("_newest"))
    return newest.select(*key, *[F.col("_newest")[name].alias(name) for name in kept]).select(*columns)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str], carry: Sequence[str]) -> DataFrame:
    """One row per key: the one with the least ``order``; ties go to the least ``carry``."""
    kept = [*order, *carry]
    first = df.groupBy(*key).agg(F.min(F.struct(*kept)).alias("_first"))
    return first.select(*key, *[F.col("_first")[name].alias(name) for name in kept])


def latest_per_kind(df: DataFrame, kind: str, order: str, tie: Sequence[str] = ()) -> DataFrame:
    """Newest row of each kind, whole (S1, O3). Each task sends on one row per kind, however many rows a kind has."""
    rest = [name for name in df.columns if name not in {kind, order, *tie}]
    return latest_per_key(df, [kind], [order, *tie], rest)


def newest_snapshot(df: DataFrame, date: str) -> DataFrame:
    """Rows of the newest date.

    The date is a scalar subquery, so it reaches the scan as a filter: on a table partitioned by it only the newest
    partition is read, on others Parquet row groups are skipped by their statistics.
    """
    newest = df.agg(F.max(date).alias("_newest"))
    return df.where(F.col(date) == newest.scalar())
