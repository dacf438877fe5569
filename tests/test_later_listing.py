"""Resolving only what two listings of the directory differ in, against resolving everybody."""

import contextlib
import datetime as dt
import io
import random
import re

import pytest
from conftest import rows

from rosterkeep.operators import identity
from rosterkeep.plans import counts, runs
from rosterkeep.plans.bindings import in_layout
from rosterkeep.model import MEMBERS
from rosterkeep.sources.directory import GROUPS, MANAGERS, USERS
from rosterkeep.sources.store import Store

DAYS = [dt.date(2026, 1, 1) + dt.timedelta(days=30 * k) for k in range(3)]


def listing(spark, people, groups):
    users = [(i, p, m, o, d, None, pos) for pos, (i, (p, m, o, d, _)) in enumerate(people.items())]
    edges = [(i, boss) for i, (*_, boss) in people.items()]
    member_of = [(i, g, k) for i, found in groups.items() for k, g in enumerate(found)]
    return runs.Directory(
        spark.createDataFrame(users, USERS), spark.createDataFrame(edges, MANAGERS), spark.createDataFrame(member_of, GROUPS), spark.createDataFrame([], "id string, name string")
    )


def changed(r, people, groups):
    """A few users changed, gone, or new; a few memberships changed."""
    people, groups = dict(people), dict(groups)
    names = [f"n{i}@d" for i in range(30)]
    for i in r.sample(sorted(people), 4) + [str(r.randrange(100, 140))]:
        people[i] = (r.choice([*names, None]), r.choice([*names, None]), r.sample(names, r.randrange(3)), r.choice("ABC"), r.choice(sorted(people)))
    people.pop(r.choice(sorted(people)))
    groups[r.choice(sorted(people))] = r.sample(["g1", "g2", "g3"], r.randrange(1, 3))
    return people, groups


@pytest.mark.parametrize("seed", range(2))
def test_later_runs_equal_full_ones(spark, tmp_path, seed):
    r = random.Random(seed)
    store = Store(spark, str(tmp_path))
    people = {str(i): (f"n{i % 25}@d", f"m{i}@d", [f"n{(i * 7) % 30}@d"] if i % 3 == 0 else [], "ABC"[i % 3], str((i + 1) % 40)) for i in range(40)}
    groups = {str(i): [f"g{i % 3}"] for i in range(0, 40, 2)}
    accounts = [(f"n{i}_org" if i % 4 else None, f"n{i}@x" if i % 3 else None, f"N{i}") for i in range(35)] + [("n1_org", "n1@x", "N1")] * 2
    resolved = []
    for day in DAYS:
        directory = listing(spark, people, groups)
        members = spark.createDataFrame(accounts, "username string, email string, name string")
        store.write_snapshot("members", day, in_layout(members, MEMBERS))
        seen, config = counts.RunCounts(), runs.RunConfig(day, "_org", "d", 100, group_digest=False)
        runs.resolve_members(store, config, directory, seen)
        want = identity.identity_status(members, directory.users, directory.manager_edges, directory.group_edges, day, "_org", "d")
        assert rows(store.snapshot("identity", day), *want.columns) == rows(want)
        resolved.append({name: value for _, name, value in seen.rows()}["resolved"])
        people, groups = changed(r, people, groups)
        accounts = accounts[1:] + [(f"n{r.randrange(30)}_org", None, f"new{day}")]
    assert resolved[0] == len(accounts) and all(0 < n < len(accounts) for n in resolved[1:])


def test_other_settings_or_snapshots_resolve_everybody(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    people = {"1": ("a@d", None, [], "A", None)}
    members = in_layout(spark.createDataFrame([("a_org", None, "A")], "username string, email string, name string"), MEMBERS)

    def run(day, domain="d"):
        store.write_snapshot("members", day, members)
        seen = counts.RunCounts()
        runs.resolve_members(store, runs.RunConfig(day, "_org", domain, 100), listing(spark, people, {"1": ["g"]}), seen)
        return {name: value for _, name, value in seen.rows()}["resolved"]

    assert [run(DAYS[0]), run(DAYS[1]), run(DAYS[2], "other")] == [1, 0, 1]
    later = [DAYS[2] + dt.timedelta(days=k) for k in (1, 2, 3)]
    store.write_snapshot("identity", later[0], store.snapshot("identity"))
    assert run(later[1], "other") == 1
    store.expire(dt.datetime(9999, 1, 1, tzinfo=dt.timezone.utc))
    assert run(later[2], "other") == 0


def test_groups_as_digest_and_memberships(spark, tmp_path):
    """The state has no text of the groups, yet every change of it is a state; reports have the text."""
    from rosterkeep.sources import reports

    store = Store(spark, str(tmp_path))
    people = {"1": ("a@d", None, [], "A", None), "2": ("b@d", None, [], "A", None)}
    members = in_layout(spark.createDataFrame([("a_org", None, "A"), ("b_org", None, "B"), ("c_org", None, "C")], "username string, email string, name string"), MEMBERS)
    lists = [["g1", "g2"], ["g2", "g1"], ["g2", "g1", "g1"]]
    for day, groups in zip(DAYS, lists):
        config = runs.RunConfig(day, "_org", "d", 100)
        for kind in ("identity", "memberships"):
            runs.fold_history(store, config, kind)
        store.write_snapshot("members", day, members)
        runs.resolve_members(store, config, listing(spark, people, {"1": groups}))
        path = store.report_path(reports.dated_name("EntraID_Status", day))
        assert rows(reports.read_text_columns(spark, path), "Username", "Groups") == [("a_org", ", ".join(groups)), ("b_org", None), ("c_org", None)]
    later = runs.RunConfig(DAYS[-1] + dt.timedelta(days=1), "_org", "d", 100)
    for kind in ("identity", "memberships"):
        runs.fold_history(store, later, kind)
    history = store.history("identity").where("username = 'a_org'")
    assert rows(history, "updated_date") == [(DAYS[0],), (DAYS[1],), (DAYS[2],)] and history.where("groups like '%g1%'").isEmpty()
    assert rows(store.history("memberships"), "group_id", "pos", "updated_date") == [("g1", 0, DAYS[0]), ("g1", 1, DAYS[2]), ("g1", 2, DAYS[2]), ("g2", 0, DAYS[2]), ("g2", 1, DAYS[0])]


def test_digest_is_of_all_groups_in_order(spark):
    def digest(edges, parts=1):
        df = spark.createDataFrame(edges, "user_id string, group_id string, pos int").repartition(parts)
        return identity.group_digest(df).first()["groups"]

    base = [("u", f"g{i}", i) for i in range(200)]
    assert digest(base) == digest(base[::-1], 7)
    others = [base[:-1], base + [base[0]], [("u", "x", 0), *base[1:]], [("u", "g0", 1), ("u", "g1", 0), *base[2:]]]
    assert len({digest(e) for e in [base, *others]}) == 5
    assert digest([("u", "a", 0)] * 2) != digest([("u", "b", 0)] * 2)


def test_groups_are_not_shuffled_with_the_accounts(spark, tmp_path):
    """Very many accounts may lead to a user of very many groups; the text of them goes to the rows in the last join."""
    plans = []

    class Watched(Store):
        def write_snapshot(self, kind, date, df, judge=None):
            if kind == "identity":
                out = io.StringIO()
                with contextlib.redirect_stdout(out):
                    df.explain("formatted")
                plans.append(out.getvalue())
            return super().write_snapshot(kind, date, df, judge)

    store = Watched(spark, str(tmp_path))
    people = {"1": ("a@d", None, [], "A", "2"), "2": ("b@d", "boss@d", [], "B", None)}
    accounts = [("a_org", f"x{i}@y", f"N{i}") for i in range(30)] + [(None, None, "nobody")] * 2
    for day, groups in zip(DAYS, (["g1"], ["g1"], ["g2", "g1"])):
        store.write_snapshot("members", day, in_layout(spark.createDataFrame(accounts, "username string, email string, name string"), MEMBERS))
        runs.resolve_members(store, runs.RunConfig(day, "_org", "d", 100, group_digest=False), listing(spark, people, {"1": groups}))
        found = store.snapshot("identity", day).groupBy("username", "manager_email", "groups").count()
        assert rows(found) == [(None, None, None, 2), ("a_org", "boss@d", ", ".join(groups), 30)]
    for plan in plans:
        shuffled = re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]", plan)
        assert shuffled and not [columns for columns in shuffled if "groups#" in columns and "name#" in columns]
        assert not [read for read in re.findall("ReadSchema: (.*)", plan) if "emails_tried" in read and "groups" in read]
