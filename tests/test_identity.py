import pytest
from conftest import RUN_DATE, rows
from pyspark.sql import functions as F

from rosterkeep.operators import identity
from rosterkeep.sources.directory import GROUPS, MANAGERS, USERS

NO_MAILS: list[str] = []


@pytest.fixture
def directory(spark):
    people = [
        ("1", "ann@d", "ann.mail@d", ["ann@home"], "Law", None, 1),
        ("2", "bob@d", "shared@d", ["old@x", "cy@home"], "Art", None, 2),
        ("3", "cy@d", "shared@d", ["cy@home", None, " "], "Bio", None, 3),
        ("4", None, "dan@d", ["dan@home"], "", None, 4),
        ("5", "Eve.X@d", None, ["eve@d"], None, None, 5),
        ("6", "  ", "fay@d", ["fay@home"], "Gym", None, 6),
        ("7", " Gus@d ", "gus.mail@d", None, "Zoo", None, 7),
    ]
    return spark.createDataFrame(people, USERS)


@pytest.fixture
def manager_edges(spark):
    return spark.createDataFrame([("1", "2"), ("2", "99"), ("3", "5"), ("4", "4"), ("5", None), (None, "1")], MANAGERS)


@pytest.fixture
def group_edges(spark):
    return spark.createDataFrame([("1", "g2", 2), ("1", "g1", 1), ("2", "g9", 1), ("1", None, 0), (None, "g1", 0)], GROUPS)


@pytest.fixture
def status(spark, directory, manager_edges, group_edges):
    def run(*accounts, suffix="_org"):
        members = spark.createDataFrame([(u, e, "N") for u, e in accounts], "username string, email string, name string")
        return identity.identity_status(members, directory, manager_edges, group_edges, RUN_DATE, suffix, "d")

    return run


def test_principal_index(directory):
    index = rows(identity.principal_index(directory), "key", "user_id")
    assert ("shared@d", "2") in index and ("dan@d", "4") in index and ("eve.x@d", "5") in index and ("gus@d", "7") in index
    assert len(index) == 10


def test_other_mail_index(directory):
    assert rows(identity.other_mail_index(directory)) == [
        ("ann@home", "ann@d"), ("cy@home", "bob@d"), ("eve@d", "Eve.X@d"), ("fay@home", "  "), ("old@x", "bob@d"),
    ]


def test_status_row_of_a_match(status):
    assert rows(
        status(("ann_org", "ANN@d")),
        "emails_tried", "entra_status", "working_email", "user_department", "manager_email", "manager_department", "groups", "directory_id", "updated_date",
    ) == [("ANN@d, ann@d", True, "ANN@d", "Law", "shared@d", "Art", "g1, g2", "1", RUN_DATE)]


def test_status_row_without_a_match(status):
    assert rows(status(("zed", None)), "emails_tried", "entra_status", "working_email", "user_department", "manager_email", "groups", "directory_id") == [
        ("zed@d, @d", False, None, None, None, None, None)
    ]


def test_resolution(status):
    cases = [
        ("bob", "nobody@x", "bob@d", "2"),  # second candidate
        ("bob", "ann@d", "ann@d", "1"),  # both known: the first
        ("x", "shared@d", "shared@d", "2"),  # a key of two users: the one listed first
        ("x", "ann@home", "ann@d", "1"),  # other mail, and the address formed from it
        ("y", "old@x", "bob@d", "2"),  # other mail only: its user's principal name
        ("eve", "eve@d", "Eve.X@d", "5"),  # a single candidate and an alternate
        ("fay", "fay@home", "fay@d", "6"),
        ("q", "gus.mail@d", "gus.mail@d", "7"),
    ]
    df = status(*[case[:2] for case in cases])
    assert rows(df, "username", "email", "working_email", "directory_id") == sorted(cases)


def test_alternate_is_noted_once(status):
    tried = dict(rows(status(("y", "old@x"), ("BOB", "old@x"), ("c", "cy@home")), "username", "emails_tried"))
    assert tried == {"y": "old@x, y@d, old@d, bob@d", "BOB": "old@x, BOB@d, old@d", "c": "cy@home, c@d, cy@d, bob@d"}


def test_blank_principal_name_ends_the_search(status):
    assert rows(status(("nn", "fay@home")), "emails_tried", "working_email") == [("fay@home, nn@d, fay@d", "fay@d")]


def test_one_row_per_member_row(status):
    df = status(("ann", None), ("ann", None), (None, None), (None, "bob@d"), ("zed", ""))
    assert rows(df, "username", "email", "entra_status") == [
        (None, None, False), (None, "bob@d", True), ("ann", None, True), ("ann", None, True), ("zed", "", False),
    ]


def test_managers(directory, manager_edges):
    assert rows(identity.managers(manager_edges, directory)) == [("1", "shared@d", "Art"), ("3", None, None), ("4", "dan@d", "")]


def test_blank_manager_values_are_null(status):
    assert rows(status(("dan", None)), "manager_email", "manager_department", "user_department") == [("dan@d", None, None)]


def test_group_text_is_cut_exactly(spark):
    edges = spark.createDataFrame([("u", f"{i:03d}", i) for i in range(700)] + [("v", "", i) for i in range(700)], GROUPS)
    whole = dict(rows(identity.group_text(edges)))
    assert whole == {"u": ", ".join(f"{i:03d}" for i in range(700)), "v": ", ".join([""] * 700)}
    assert dict(rows(identity.group_text(edges, 1000))) == {user: text[:1000] for user, text in whole.items()}
    short = dict(rows(identity.group_text(edges, 7)))
    assert short == {"u": "000, 00", "v": ", , , ,"}


def test_tried_text_is_cut_on_request(spark, status, directory, manager_edges, group_edges):
    long = "x" * 600
    assert [len(r[0]) for r in status((long, None)).select("emails_tried").collect()] == [606]
    members = spark.createDataFrame([(long, None, None)], "username string, email string, name string")
    cut = identity.identity_status(members, directory, manager_edges, group_edges, RUN_DATE, "", "d", legacy_truncate=True)
    assert [len(r[0]) for r in cut.select("emails_tried").collect()] == [500]


def test_errors(status):
    assert rows(identity.error_rows(status((" ", "a@x"), (None, None), ("ann", None))), "username") == [(None,), (" ",)]


def test_same_result_however_the_members_are_split(spark, directory, manager_edges, group_edges):
    members = spark.range(200).select(
        F.concat(F.lit("u"), F.col("id") % 7).alias("username"),
        F.when(F.col("id") % 3 > 0, F.lit("cy@home")).alias("email"),
        F.col("id").cast("string").alias("name"),
    )
    got = [
        rows(identity.identity_status(members.repartition(n), directory, manager_edges, group_edges, RUN_DATE, "", "d")) for n in (1, 7)
    ]
    assert got[0] == got[1] and len(got[0]) == 200
