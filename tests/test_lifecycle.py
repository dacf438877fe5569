import datetime as dt

from conftest import RUN_DATE, rows
from pyspark.sql import functions as F

from rosterkeep.model import STATE
from rosterkeep.operators import lifecycle
from rosterkeep.operators.keys import mark_listed

OLD = dt.date(2025, 12, 1)
IDENTITY = "username string, entra_status boolean, groups string, directory_id string, updated_date date"


def days_ago(n):
    return RUN_DATE - dt.timedelta(days=n)


def state_rows(spark, data):
    """State rows from (username, status, flag date, override)."""
    full = [(u, u, f"{u}@d", None, s, f, OLD, o, OLD) for u, s, f, o in data]
    return spark.createDataFrame(full, STATE.schema)


def facts_rows(spark, data):
    df = spark.createDataFrame(data, "username string, entra_status boolean, empty boolean, whitelisted boolean")
    return df.withColumn("_user", F.concat(F.lit("="), "username")).drop("username")


#: status, flag date, override, identity status, empty, whitelisted; then the rule, new status, flag and delete date
CASES = [
    (0, None, True, False, True, False, "R1", 0, None, None),
    (1, days_ago(90), True, False, False, False, "R1", 0, None, None),
    (2, days_ago(90), True, None, False, False, "R1", 0, None, None),
    (0, None, False, True, True, True, "R2", 2, RUN_DATE, OLD),
    (1, days_ago(40), False, False, True, False, "R2", 2, RUN_DATE, OLD),
    (2, days_ago(40), False, False, True, False, "R2", 2, RUN_DATE, OLD),
    (0, None, False, False, False, False, "R3", 1, RUN_DATE, OLD),
    (0, None, None, False, False, False, "R3", 1, RUN_DATE, OLD),
    (0, days_ago(5), False, True, False, True, "R4", 0, None, None),
    (0, None, False, True, False, False, "R5", 1, RUN_DATE, OLD),
    (0, days_ago(5), False, None, False, False, "R6", 0, days_ago(5), OLD),
    (1, days_ago(29), False, False, False, False, "R8", 1, days_ago(29), OLD),
    (1, days_ago(30), False, False, False, False, "R7", 2, days_ago(30), RUN_DATE),
    (1, days_ago(31), False, False, False, False, "R7", 2, days_ago(31), RUN_DATE),
    (1, days_ago(30), False, True, False, True, "R7", 2, days_ago(30), RUN_DATE),
    (1, None, False, False, False, False, "R8", 1, None, OLD),
    (2, days_ago(99), False, True, False, True, "R8", 2, days_ago(99), OLD),
    (None, None, False, True, False, True, "R8", None, None, OLD),
]


def test_rules(spark):
    state = state_rows(spark, [(f"u{i:02d}", status, flag, override) for i, (status, flag, override, *_) in enumerate(CASES)])
    facts = facts_rows(spark, [(f"u{i:02d}", entra, empty, listed) for i, (_, _, _, entra, empty, listed, *_) in enumerate(CASES)])
    moved = lifecycle.transition(state, facts, RUN_DATE)
    got = rows(moved, "username", "rule", "delete_status", "flag_date", "delete_date", "old_status", "updated_date")
    for i, (status, _, _, _, _, _, rule, new, new_flag, new_delete) in enumerate(CASES):
        assert got[i] == (f"u{i:02d}", rule, new, new_flag, new_delete, status, OLD), CASES[i]


def test_user_without_facts_stays(spark):
    moved = lifecycle.transition(state_rows(spark, [("u", 0, None, False)]), facts_rows(spark, [("v", False, True, False)]), RUN_DATE)
    assert rows(moved, "rule", "delete_status") == [("R6", 0)]


def test_grace_is_a_parameter(spark):
    state, facts = state_rows(spark, [("u", 1, days_ago(7), False)]), facts_rows(spark, [("u", False, False, False)])
    assert rows(lifecycle.transition(state, facts, RUN_DATE, grace_days=7), "rule") == [("R7",)]


def test_second_run_on_the_same_date_changes_nothing(spark):
    data = [(f"u{i}", s, days_ago(d) if s else None, False) for i, (s, d) in enumerate([(0, 0), (1, 30), (1, 3), (2, 50)])]
    facts = facts_rows(spark, [(f"u{i}", False, False, False) for i in range(4)])
    once = lifecycle.transition(state_rows(spark, data), facts, RUN_DATE).select(*STATE.columns)
    twice = lifecycle.transition(once, facts, RUN_DATE).select(*STATE.columns)
    assert rows(once) == rows(twice)


def test_duplicate_state_rows_are_kept(spark):
    state = state_rows(spark, [("u", 0, None, False), ("u", 1, days_ago(30), False), (None, 0, None, False)])
    moved = lifecycle.transition(state, facts_rows(spark, [("u", False, False, False)]), RUN_DATE)
    assert rows(moved, "username", "rule") == [(None, "R6"), ("u", "R3"), ("u", "R7")]


def test_users_without_items(spark):
    members = spark.createDataFrame([("none",), ("one",), ("idless",), ("mixed",), (None,), ("none",)], "username string")
    items = spark.createDataFrame([("1", "one"), (None, "idless"), (None, "mixed"), ("2", "mixed"), ("3", None)], "item_id string, owner string")
    assert rows(lifecycle.users_without_items(members, items)) == [(None,), ("idless",), ("mixed",), ("none",)]


def test_users_without_items_caseless(spark):
    members = spark.createDataFrame([("ANN",), ("bob",)], "username string")
    items = spark.createDataFrame([("1", "ann ")], "item_id string, owner string")
    assert rows(lifecycle.users_without_items(members, items, "caseless")) == [("bob",)]


def test_new_accounts_keep_duplicates_and_match_null(spark):
    identity = spark.createDataFrame(
        [("a", "A", "a@d", None), ("b", "B", None, "m@d"), ("b", "B2", None, None), (None, "N", None, None)],
        "username string, name string, working_email string, manager_email string",
    )
    state = state_rows(spark, [("a", 2, OLD, True), (None, 0, None, False)])
    added = lifecycle.add_new_accounts(state, identity, RUN_DATE)
    assert rows(added, "username", "name", "delete_status", "flag_date", "override", "updated_date") == [
        (None, None, 0, None, False, OLD), ("a", "a", 2, OLD, True, OLD), ("b", "B", 0, None, False, RUN_DATE), ("b", "B2", 0, None, False, RUN_DATE),
    ]


def test_facts_take_the_newest_identity_row(spark):
    identity = spark.createDataFrame(
        [("u", True, "g1", "1", OLD), ("u", False, "g2", "2", RUN_DATE), ("v", True, " g2 ,x", "3", OLD), (None, True, "g1", "4", OLD)], IDENTITY
    )
    empty = spark.createDataFrame([("v",), ("w",), (None,)], "username string")
    listed = spark.createDataFrame([("g2",), ("g1",), ("g2",), (None,)], "id string")
    facts = lifecycle.account_facts(identity, empty, listed)
    assert rows(facts, "_user", "entra_status", "empty", "whitelisted") == [
        ("", None, True, False), ("=u", False, False, False), ("=v", True, True, True), ("=w", None, True, False),
    ]


def test_null_user_is_found_among_the_empty_ones_only(spark):
    identity = spark.createDataFrame([(None, False, None, None, OLD)], IDENTITY)
    empty = spark.createDataFrame([(None,)], "username string")
    listed = spark.createDataFrame([], "id string")
    state = state_rows(spark, [(None, 0, None, False)])
    with_empty = lifecycle.transition(state, lifecycle.account_facts(identity, empty, listed), RUN_DATE)
    without = lifecycle.transition(state, lifecycle.account_facts(identity, empty.limit(0), listed), RUN_DATE)
    assert rows(with_empty, "rule") == [("R2",)] and rows(without, "rule") == [("R6",)]


def test_whitelist_by_text_and_by_membership(spark):
    ids = [f"{i:036d}" for i in range(30)]
    text = ", ".join(ids)[:1000]
    identity = spark.createDataFrame([("u", True, text, "d1", OLD), ("v", True, None, "d2", OLD), ("w", True, None, None, OLD)], IDENTITY)
    edges = spark.createDataFrame([("d1", g) for g in ids], "user_id string, group_id string")
    nobody = spark.createDataFrame([], "username string")
    late = spark.createDataFrame([(ids[26],)], "id string")
    early = spark.createDataFrame([(ids[25],)], "id string")

    def listed(whitelist, group_edges=None):
        return rows(lifecycle.account_facts(identity, nobody, whitelist, group_edges).where("whitelisted"), "_user")

    assert listed(late) == [] and listed(early) == [("=u",)]
    assert listed(late, edges) == [("=u",)] and listed(early, edges) == [("=u",)]


def test_mark_listed_with_null_keys(spark):
    df = spark.createDataFrame([(None, "a"), ("x", "b"), ("y", "c")], "k string, row string")
    ids = spark.createDataFrame([("x",), ("a",), (None,)], "id string")
    assert rows(mark_listed(df, F.col("k"), F.col("id"), ids, "hit", F.col("row")), "row", "hit") == [("a", False), ("b", True), ("c", False)]


def test_counts(spark):
    data = [("a", 0, None, True), ("b", 0, None, False), ("c", 1, days_ago(3), False), ("d", 1, days_ago(60), False), ("e", 2, None, False), ("f", 0, None, False)]
    facts = facts_rows(spark, [(u, False, False, False) for u in "abcde"] + [("f", True, True, False)])
    moved = lifecycle.transition(state_rows(spark, data), facts, RUN_DATE)
    assert rows(lifecycle.rule_counts(moved)) == [("R1", 0, 1), ("R2", 2, 1), ("R3", 1, 1), ("R7", 2, 1), ("R8", 1, 1), ("R8", 2, 1)]
    assert rows(lifecycle.legacy_counters(moved), "unflagged", "flagged", "deleted") == [(2, 2, 2)]


def test_delete_list_is_sorted_and_distinct(spark):
    state = state_rows(spark, [("b", 2, None, False), ("a", 2, None, False), ("b", 2, None, False), ("c", 1, None, False)])
    assert [r[0] for r in lifecycle.delete_list(state).collect()] == ["a", "b"]
    assert lifecycle.in_status(state, 1).count() == 1


def test_overrides(spark):
    state = state_rows(spark, [("a", 2, None, False), ("b", 1, None, None), ("c", 0, None, True), ("d", 0, None, False)])
    state = state.withColumn("working_email", F.when(F.col("username") != "d", F.col("working_email")))
    asked = spark.createDataFrame([("a@d", True), ("a@d", False), ("c@d", False), (None, True)], "working_email string, override boolean")
    assert rows(lifecycle.apply_overrides(state, asked), "username", "override") == [("a", True), ("b", None), ("c", False), ("d", False)]
    assert rows(lifecycle.by_working_email(state, "a@d"), "username") == [("a",)]
