import re

import pytest

from helpers import LONG, documents, needs_tables, small_documents
from rosterkeep.llm import license_scan

MIT, APACHE = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text):
    words = WORD.findall((text or "").lower())
    return [tuple(words[i : i + 3]) for i in range(len(words) - 2)]


def plain(text):
    """Licenses of which some stretch as long as the scan's regions holds enough shingles."""
    own, found = shingles(text), set()
    for name, notice in license_scan.TEMPLATES:
        want = set(shingles(notice))
        size = license_scan.WINDOW + 2 * len(want)
        if any(len(want & set(own[i : i + size])) >= license_scan.CONTAINED * len(want) for i in range(max(1, len(own)))):
            found.add(name)
    return found


def names(spark, rows, **kinds):
    return [(r["doc_id"], {x["license"] for x in r["found"]}) for r in license_scan.scan(documents(spark, rows), **kinds).collect()]


def test_notices_at_any_place(spark):
    rows = [(i * 100 + k, "word " * k + notice + " more" * k) for i, (_, notice) in enumerate(license_scan.TEMPLATES) for k in range(6)]
    for (i, text), (j, got) in zip(sorted(rows), sorted(names(spark, rows))):
        assert i == j and license_scan.TEMPLATES[i // 100][0] in got and got == plain(text)


def test_changed_words(spark):
    long = license_scan.TEMPLATES[1][1]
    some, many = long.replace("compliance", "accordance"), re.sub(r"(\w+) (\w+)", r"\1 x \2", long)
    assert dict(names(spark, [(1, some), (2, many), (3, "Licensed under the Apache")])) == {1: {"Apache-2.0"}, 2: set(), 3: set()}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "mit license"), (4, LONG + MIT + LONG), (5, f"{MIT} {APACHE}"), (5, f"{MIT} {APACHE}"), (None, MIT), (6, "...")]
    got = names(spark, rows)
    assert sorted(got, key=str) == sorted([(1, set()), (2, set()), (3, set()), (4, {"MIT"}), (5, {"MIT", "Apache-2.0"}), (5, {"MIT", "Apache-2.0"}), (None, {"MIT"}), (6, set())], key=str)
    assert names(spark, []) == []
    assert names(spark, [(1, MIT)], templates=(("x", "too short"),)) == [(1, set())]


def test_place_and_share(spark):
    row = license_scan.scan(documents(spark, [(1, "a b c d e f g " + MIT)])).first()
    assert [tuple(x) for x in row["found"]] == [("MIT", 1.0, row["found"][0]["word"])] and row["found"][0]["word"] <= 7


def test_collision_probability():
    assert license_scan.collision_probability(1.0) == 1.0
    assert 0 < license_scan.collision_probability(0.5) < license_scan.collision_probability(0.8) < 1


@pytest.mark.skipif(needs_tables(), reason="no test tables")
def test_test_documents(spark):
    rows = [(i, t) for i, t, _ in small_documents()]
    assert sorted(names(spark, rows)) == sorted((i, plain(t)) for i, t in rows)


def test_no_python_in_the_plan(spark):
    plan = license_scan.scan(documents(spark, [(1, MIT)]))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
