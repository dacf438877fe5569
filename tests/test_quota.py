import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterkeep.operators import quota


@pytest.fixture
def members(spark):
    names = [(u, f"{u}@d", u.upper()) for u in "abcdef"] + [("twice", "t@d", "T"), ("twice", "t@d", "T"), (None, "n@d", "N")]
    return spark.createDataFrame(names, "username string, email string, name string")


@pytest.fixture
def items(spark):
    data = [
        ("a", 60.0, 0.0), ("a", 40.0, 0.0), ("b", 100.01, 0.0), ("c", None, 0.0), ("d", None, 0.0), ("d", 101.0, 0.0),
        ("e", 1.0, 9999.0), ("twice", 60.0, 0.0), (None, 500.0, 0.0), ("stranger", 500.0, 0.0),
    ]
    return spark.createDataFrame(data, "owner string, feature_storage_size double, file_storage_size double")


def test_over_quota(members, items):
    got = [tuple(r) for r in quota.over_quota(members, items, 100).collect()]
    assert got == [("twice", "t@d", "T", 120.0), ("d", "d@d", "D", 101.0), ("b", "b@d", "B", 100.01)]


def test_negative_quota_counts_owners_of_nothing(members, items):
    assert ("f",) not in rows(quota.over_quota(members, items, -1), "username")
    assert ("e",) in rows(quota.over_quota(members, items, 0.5), "username")


def test_totals_do_not_depend_on_order(spark, members):
    items = spark.createDataFrame([("a", v) for v in [0.1] * 10 + [1e9]], "owner string, feature_storage_size double")
    assert quota.over_quota(members, items, 1_000_000_001).count() == 0
    assert quota.over_quota(members, items, 1_000_000_000.999999).head()["total_feature_storage_mb"] == 1_000_000_001.0


def test_caseless(spark, items):
    people = spark.createDataFrame([("A ", "e", "n"), ("B", "e", "n")], "username string, email string, name string")
    assert rows(quota.over_quota(people, items, 90, "caseless"), "username", "total_feature_storage_mb") == [("A ", 100.0), ("B", 100.01)]


def test_sizes_beyond_decimals_are_listed(spark):
    members = spark.createDataFrame([(u, None, None) for u in ("a", "b", "c", "d")], "username string, email string, name string")
    sizes = [("a", float("inf")), ("a", 1.0), ("b", 1e23), ("b", 2.0), ("c", None), ("d", float("-inf"))]
    items = spark.createDataFrame(sizes, "owner string, feature_storage_size double")
    assert rows(quota.over_quota(members, items, 5), "username", "total_feature_storage_mb") == [("a", float("inf")), ("b", 1e23)]


def test_totals_of_any_scale_do_not_depend_on_order(spark):
    """Shuffled and dealt differently, the same double: sizes from 1e-3 to 1e300, of both signs."""
    import random
    from fractions import Fraction

    r = random.Random(1)
    sizes = [r.choice([1, -1]) * r.random() * 10.0 ** r.randrange(-3, 300) for _ in range(400)] + [1e300, -1e300, 5e-324, 1.7e308, -1.7e308]
    totals = set()
    for k in range(4):
        r.shuffle(sizes)
        items = spark.createDataFrame([("a", x) for x in sizes], "owner string, feature_storage_size double").repartition(k + 1)
        row = quota.storage_by_owner(items).select("_beyond", quota.total_size(F.lit(1)).alias("total")).first()
        totals.add((row["_beyond"], row["total"]))
    assert len(totals) == 1
    # Each power's sum is exact.
    big = [x for x in sizes if abs(x) >= 1e22]
    assert totals.pop()[0] == pytest.approx(float(sum(map(Fraction, big))), rel=1e-15)


def test_infinite_sizes(spark):
    inf = float("inf")
    items = spark.createDataFrame([("a", inf), ("a", 1e30), ("b", inf), ("b", -inf), ("c", 1e25), ("c", 1e25)], "owner string, feature_storage_size double")
    got = {r["_owner"]: r["_beyond"] for r in quota.storage_by_owner(items).collect()}
    assert got["a"] == inf and got["b"] != got["b"] and got["c"] == 2e25
