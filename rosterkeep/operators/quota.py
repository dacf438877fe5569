"""Owners above the storage quota."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rosterkeep.functions.text import caseless
from rosterkeep.operators.keys import same_key

#: Sizes are added as decimals, so a total does not depend on the order of its parts.
SIZE = "decimal(28,6)"


def storage_by_owner(items: DataFrame, match: str = "binary") -> DataFrame:
    """Total feature storage per owner (A1): ``_owner``, ``_total`` and ``_beyond``.

    Sizes that no decimal holds are added in ``_beyond``, NULL without any: finite ones as whole multiples of a power of two,
    a sum for each power, which is exact; the few sums of an owner are then put together in order of their powers. So no
    total depends on the order of the rows, at any scale. Infinite ones stay infinite. An owner whose sizes are all NULL has
    NULL in both.
    """
    owner = caseless(F.col("owner")) if match == "caseless" else F.col("owner")
    size = F.col("feature_storage_size").cast("double")
    exact = F.col("feature_storage_size").try_cast(SIZE)
    finite = F.abs(size) < float("inf")
    beyond = exact.isNull() & size.isNotNull()
    # 53 bits below the leading one: the size is a whole multiple of that power, also if the logarithm is off by one.
    power = F.when(beyond & finite, F.floor(F.log2(F.abs(size))).cast("int") - 53)
    rows = items.where("owner is not null").select(
        owner.alias("_owner"), power.alias("_power"), exact.alias("_exact"), size.alias("_size"), F.when(beyond & ~finite, size).alias("_infinite")
    )
    times = (F.col("_size") / F.pow(F.lit(2.0), "_power")).cast("decimal(20,0)")
    sums = rows.groupBy("_owner", "_power").agg(F.sum("_exact").alias("_exact"), F.sum(times).alias("_times"), F.sum("_infinite").alias("_infinite"))
    listed = F.array_sort(F.collect_list(F.when(F.col("_power").isNotNull(), F.struct("_power", "_times"))))
    of_owner = sums.groupBy("_owner").agg(F.sum("_exact").alias("_total"), listed.alias("_list"), F.sum("_infinite").alias("_infinite"))
    added = F.aggregate("_list", F.lit(0.0), lambda total, x: total + x["_times"].cast("double") * F.pow(F.lit(2.0), x["_power"]))
    finite_part = F.when(F.size("_list") > 0, added)
    whole = F.when(F.col("_infinite").isNull(), finite_part).otherwise(F.coalesce(finite_part, F.lit(0.0)) + F.col("_infinite"))
    return of_owner.select("_owner", "_total", whole.alias("_beyond"))


def total_size(times: Column) -> Column:
    """The whole total as a double, each size counted so many ``times``."""
    exact = (F.col("_total") * times).cast("double")
    return F.when(F.col("_beyond").isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + F.col("_beyond") * times)


def over_quota(members: DataFrame, items: DataFrame, quota_mb: float, match: str = "binary") -> DataFrame:
    """Members whose items together exceed the quota, largest first (L5: J1, A1, P10, O1).

    Items are summed per owner before the join, so an owner of very many items costs one row in it. A member row that
    occurs n times counts its items n times, as joining row by row would.
    """
    limit = F.lit(str(quota_mb)).cast(SIZE)
    totals = storage_by_owner(items, match).where("_total is not null or _beyond is not null")
    if quota_mb >= 0:
        totals = totals.where("_total > 0 or _beyond > 0")
    named = members.where("username is not null")
    if match == "caseless":
        shown = [F.min(name).alias(name) for name in ("username", "email", "name")]
        by = {f"_{name}": caseless(F.col(name)) for name in ("username", "email", "name")}
        people = named.withColumns(by).groupBy(*by).agg(*shown, F.count(F.lit(1)).alias("_n"))
        user = F.col("_username")
    else:
        people = named.groupBy("username", "email", "name").agg(F.count(F.lit(1)).alias("_n"))
        user = F.col("username")
    above = F.when(F.col("_beyond").isNull(), F.col("_total") * F.col("_n") > limit).otherwise(total_size(F.col("_n")) > quota_mb)
    return (
        people.join(totals, same_key(user, F.col("_owner")))
        .where(above)
        .select("username", "email", "name", total_size(F.col("_n")).alias("total_feature_storage_mb"))
        .orderBy(F.desc("total_feature_storage_mb"), "username", "email", "name")
    )
