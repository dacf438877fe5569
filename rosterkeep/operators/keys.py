"""Join keys that treat NULL the way the caller needs, without piling NULLs into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def null_safe_key(c: Column) -> Column:
    """Text key under which NULL equals NULL and nothing else.

    A plain equality on it lets an aggregate and a join share one shuffle, which ``<=>`` would not.
    """
    return F.coalesce(F.concat(F.lit("="), c), F.lit(""))


def same_key(left: Column, right: Column) -> Column:
    """Equality for a join with a side that was aggregated by its key.

    Spark reuses the partitioning of that aggregate and shuffles only the other side, but adaptive execution can split
    a hot key only where both sides are shuffled right before the join. The digests are equal whenever the keys are;
    as a second key they make Spark shuffle the aggregated side too, which is one row per key by then.
    """
    return (left == right) & (F.xxhash64(left) == F.xxhash64(right))


def mark_listed(df: DataFrame, key: Column, listed: Column, ids: DataFrame, flag: str, spread: Column) -> DataFrame:
    """Add ``flag``: whether ``key`` occurs among the ids. Rows stay as they are, one for one.

    The ids are reduced to distinct values first. Rows with a NULL key can match nothing; they are spread over the
    tasks by ``spread`` instead of meeting in one. No broadcast is forced: Spark broadcasts the ids when their
    measured size allows and shuffles otherwise.
    """
    wanted = ids.select(listed.alias("_id")).where("_id is not null").distinct().withColumn("_listed", F.lit(True))
    joined = df.withColumn("_has_key", key.isNotNull()).withColumn("_probe", F.coalesce(key, spread))
    return (
        joined.join(wanted, same_key(F.col("_probe"), F.col("_id")) & F.col("_has_key"), "left")
        .withColumn(flag, F.coalesce(F.col("_listed"), F.lit(False)))
        .drop("_has_key", "_probe", "_id", "_listed")
    )


def missing_from(df: DataFrame, other: DataFrame, column: str) -> DataFrame:
    """Rows whose key is not in the other table; NULL counts as a value. All duplicates are kept."""
    known = other.select(F.col(column).alias("_known")).distinct()
    return df.join(known, F.col(column).eqNullSafe(F.col("_known")), "left_anti")
