import datetime as dt

import pytest
from pyspark.sql import functions as F

from rosterkeep.functions import addresses, templates, text as tx, typing as ty
from rosterkeep.model import ITEMS, KINDS, MEMBERS, UnknownKind, kind_column, kind_of


def values(spark, column, *inputs, of="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {of}")
    return [r[0] for r in df.select(column(F.col("c")).alias("v"), "i").orderBy("i").select("v").collect()]


def test_kinds_by_title(spark):
    assert kind_of("OrganizationItems_2026-05-15").name == "items"
    assert kind_of("x_EntraID_Status").name == "identity"
    with pytest.raises(UnknownKind):
        kind_of("Something")
    assert values(spark, kind_column, "OrganizationMembers_1", "Something") == ["members", None]


def test_state_keys():
    assert len(ITEMS.state_key) == 17 and "title" not in ITEMS.state_key
    assert len(MEMBERS.state_key) == 21
    assert len(KINDS["identity"].state_key) == 10


def test_strip_and_blank(spark):
    assert values(spark, tx.strip, "\t a b \n", " x ", None) == ["a b", "x", None]
    assert values(spark, tx.is_blank, None, "", " \t\r\n ", "x") == [True, True, True, False]
    assert values(spark, tx.lookup_key, " A@B.C\n") == ["a@b.c"]


def test_snapshot_name(spark):
    assert values(spark, tx.snapshot_name, "OrganizationItems_2026-05/15") == ["OrganizationItems_2026_05_15"]


def test_lenient_timestamp(spark):
    got = values(
        spark, ty.lenient_timestamp,
        "2026-05-15T10:11:12", "5/15/2026 3:04:05 PM", "5/15/2026 13:04", "5/15/2026", "2/31/2026", "x", "", None, " 2026-05-15 ",
    )
    day = dt.datetime(2026, 5, 15)
    assert got == [
        day.replace(hour=10, minute=11, second=12), day.replace(hour=15, minute=4, second=5), day.replace(hour=13, minute=4),
        day, None, None, None, None, day,
    ]


def test_lenient_timestamp_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        # An hour the zone skips.
        assert values(spark, ty.lenient_timestamp, "3/8/2026 02:30:00") == [dt.datetime(2026, 3, 8, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_date_format_of_ones_own(spark):
    assert values(spark, lambda c: ty.lenient_timestamp(c, ["dd.MM.yyyy", "d MMM yyyy"]), "15.05.2026", "3 May 2026", "1.5.2026") == [
        dt.datetime(2026, 5, 15), dt.datetime(2026, 5, 3), None,
    ]


def test_lenient_number(spark):
    got = values(spark, ty.lenient_number, "1", " 2.5 ", "1e3", ".5", "-3.", "inf", "1,000", "1d", "0x1p3", "nan", "abc", "", None)
    assert got == [1.0, 2.5, 1000.0, 0.5, -3.0, float("inf")] + [None] * 7


def test_lenient_boolean(spark):
    assert values(spark, ty.lenient_boolean, "Yes", "No", " TRUE ", "0", "maybe", "", None) == [True, False, True, False, None, None, None]


def test_addresses(spark):
    got = values(spark, lambda c: addresses.organisation_address(c, "_org", "d"), "jdoe_org", "JDOE_ORG", "jdoe@x.edu", "jdoe@x_org", "", None)
    assert got == ["jdoe@d", "JDOE@d", "jdoe@d", "jdoe@d", "@d", "@d"]


@pytest.mark.parametrize(
    "username, email, expected",
    [
        ("jdoe_org", "jdoe@d", ["jdoe@d"]),
        ("jdoe", "JDOE@d", ["JDOE@d", "jdoe@d"]),
        ("jdoe", None, ["jdoe@d", "@d"]),
        ("jdoe", "  ", ["jdoe@d", "  @d"]),
        (None, None, ["@d"]),
        (None, "a@x", ["a@x", "@d", "a@d"]),
    ],
)
def test_candidates(spark, username, email, expected):
    df = spark.createDataFrame([(username, email)], "username string, email string")
    tried = addresses.with_candidates(df, "_org", "d").select(*addresses.CANDIDATES).head()
    assert [a for a in tried if a is not None] == expected


def test_two_decimals(spark):
    assert values(spark, templates.two_decimals, 1234.5, 0.125, 2.675, -1.005, 0.0, None, of="double") == [
        "1234.50", "0.13", "2.68", "-1.01", "0.00", None,
    ]


def test_fill(spark):
    df = spark.createDataFrame([("{b}", None)], "a string, b string")
    filled = templates.fill("{{x}} {a}-{b}-{a}", {"a": F.col("a"), "b": F.col("b")})
    assert df.select(filled).head()[0] == "{x} {b}--{b}"
    with pytest.raises(KeyError):
        templates.fill("{unknown}", {})
