import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterkeep.model import IDENTITY, ITEMS, MEMBERS
from rosterkeep.operators import history, latest
from rosterkeep.plans.bindings import in_layout

D1, D2, D3 = dt.date(2026, 1, 1), dt.date(2026, 2, 1), dt.date(2026, 3, 1)


def items(spark, *data):
    """Item rows (title, item_id, owner, date)."""
    return in_layout(spark.createDataFrame(list(data), "title string, item_id string, owner string, updated_date date"), ITEMS)


SHOWN = ["title", "item_id", "owner", "updated_date"]


def test_append_by_name(spark):
    known = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    arrived = spark.createDataFrame([("y", 5, "lost")], "b string, a int, z string")
    assert rows(history.append_by_name(known, arrived)) == [(1, "x", 2.0), (5, "y", None)]


def test_append_compares_names_with_case(spark):
    known = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows(history.append_by_name(known, spark.createDataFrame([(7, 8)], "A int, b int"))) == [(None, 8), (1, 2)]


def test_append_nothing_shared(spark):
    with pytest.raises(history.NothingShared):
        history.append_by_name(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "b int"))


def test_same_state_on_three_dates(spark):
    df = items(spark, ("t", "1", "o", D1), ("t", "1", "o", D3), ("t", "1", "o", D2))
    assert rows(history.latest_states(df, ITEMS), *SHOWN) == [("t", "1", "o", D3)]


def test_null_keys_are_one_state(spark):
    df = items(spark, ("t", None, "o", D1), ("t", None, "o", D2), ("t", None, None, D1))
    assert rows(history.latest_states(df, ITEMS), *SHOWN) == [("t", None, None, D1), ("t", None, "o", D2)]


def test_state_that_comes_back_keeps_the_later_date(spark):
    df = items(spark, ("t", "1", "a", D1), ("t", "1", "b", D2), ("t", "1", "a", D3))
    assert rows(history.latest_states(df, ITEMS), *SHOWN) == [("t", "1", "a", D3), ("t", "1", "b", D2)]


def test_newest_title_wins(spark):
    df = items(spark, ("old", "1", "a", D1), ("new", "1", "a", D2), ("old", "1", "a", None))
    assert rows(history.latest_states(df, ITEMS), *SHOWN) == [("new", "1", "a", D2)]


def test_null_date_is_lowest(spark):
    df = in_layout(spark.createDataFrame([("u", None), ("u", D1), ("v", None)], "username string, updated_date date"), MEMBERS)
    assert rows(history.latest_states(df, MEMBERS), "username", "updated_date") == [("u", D1), ("v", None)]


def test_caseless(spark):
    df = items(spark, ("t", "A", "o", D1), ("t", "a  ", "O", D2), ("t", "b", "o", D1))
    assert rows(history.latest_states(df, ITEMS, "caseless"), *SHOWN) == [("t", "a  ", "O", D2), ("t", "b", "o", D1)]


def test_fold_begins_a_history_without_duplicates(spark):
    df = items(spark, ("t", "1", "o", D1), ("t", "1", "o", D1))
    assert rows(history.fold(None, [df], ITEMS), *SHOWN) == [("t", "1", "o", D1)]
    with pytest.raises(ValueError):
        history.fold(None, [], ITEMS)


def test_fold_at_once_is_fold_one_by_one(spark):
    parts = [items(spark, ("t", str(i % 3), "o", d), ("u", "x", str(i), d)) for i, d in enumerate((D2, D1, D3))]
    at_once = history.fold(None, parts, ITEMS)
    by_one = history.fold(history.fold(history.fold(None, parts[:1], ITEMS), parts[1:2], ITEMS), parts[2:], ITEMS)
    other_way = history.fold(None, parts[::-1], ITEMS)
    assert rows(at_once) == rows(by_one) == rows(other_way)
    assert rows(history.fold(at_once, parts, ITEMS)) == rows(at_once)


def test_open_and_closed_states(spark):
    def snapshot(date, *names):
        return in_layout(spark.createDataFrame([(n, date) for n in names], "username string, updated_date date"), IDENTITY)

    first = history.fold_open(None, [snapshot(D1, "a", "b")], IDENTITY)
    assert rows(first, "username", "open") == [("a", True), ("b", True)]
    second = history.fold_open(first.where("open").drop("open"), [snapshot(D2, "b", "c")], IDENTITY)
    assert rows(second, "username", "open") == [("a", False), ("b", True), ("c", True)]
    third = history.fold_open(second.where("open").drop("open"), [snapshot(D3, "a")], IDENTITY)
    whole = history.whole_history(second.where("not open").unionByName(third), IDENTITY)
    assert rows(whole, "username", "updated_date", "open") == [("a", D3, True), ("b", D2, False), ("c", D2, False)]


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 2, "x"), ("k", 1, "z"), ("k", 1, "y"), (None, 3, "n")], "k string, pos int, v string")
    assert rows(latest.first_per_key(df, ["k"], ["pos"], ["v"])) == [(None, 3, "n"), ("k", 1, "y")]


def test_newest_snapshot(spark):
    df = spark.createDataFrame([(1, D1), (2, D3), (3, D3), (4, None)], "i int, d date")
    assert rows(latest.newest_snapshot(df, "d"), "i") == [(2,), (3,)]


def test_latest_per_kind_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, "x", 1.0), ("a", 1, "y", 2.0), ("b", 0, "z", 3.0)], "kind string, t int, title string, v double")
    assert rows(latest.latest_per_kind(df, "kind", "t", ["title"])) == [("a", 1, "y", 2.0), ("b", 0, "z", 3.0)]


def test_floats_and_signs_in_the_key(spark):
    df = in_layout(
        spark.createDataFrame([(0.0, D1), (-0.0, D2), (float("nan"), D1), (float("nan"), D2)], "view_counts double, updated_date date"), ITEMS
    )
    assert history.latest_states(df, ITEMS).where(F.col("updated_date") == F.lit(D2)).count() == 2


def test_headers_that_differ_in_case_only(spark):
    known = spark.createDataFrame([("a", "b")], "name string, other string")
    arrived = spark.createDataFrame([("X", "c")], "NAME string, name string")
    assert rows(history.append_by_name(known, arrived)) == [("a", "b"), ("c", None)]
