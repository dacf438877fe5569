"""Invariants on random frames, against plain Python."""

import datetime as dt
import random

import pytest
from conftest import RUN_DATE, rows
from pyspark.sql import functions as F

from rosterkeep.model import IDENTITY, STATE
from rosterkeep.operators import contacts, history, identity, lifecycle, quota
from rosterkeep.plans.bindings import in_layout
from rosterkeep.sources.directory import GROUPS, MANAGERS, USERS

SEEDS = [1, 2, 3]
D0 = dt.date(2026, 1, 1)


def maybe(rng, values, share=0.15):
    return None if rng.random() < share else rng.choice(values)


@pytest.mark.parametrize("seed", SEEDS)
def test_dedupe(spark, seed):
    rng = random.Random(seed)
    data = [
        (maybe(rng, "abc"), maybe(rng, "xy"), maybe(rng, [True, False]), maybe(rng, [D0 + dt.timedelta(days=k) for k in range(5)], 0.1))
        for _ in range(300)
    ]
    df = in_layout(spark.createDataFrame(data, "username string, manager_email string, entra_status boolean, updated_date date"), IDENTITY)
    want = {}
    for *state, day in data:
        key = tuple(state)
        want[key] = max((d for d in (want.get(key), day) if d), default=None)
    shown = ["username", "manager_email", "entra_status", "updated_date"]
    once = history.latest_states(df, IDENTITY)
    assert rows(once, *shown) == sorted(((*k, d) for k, d in want.items()), key=lambda t: tuple((v is not None, str(v)) for v in t))
    assert rows(history.latest_states(once, IDENTITY)) == rows(once)
    assert rows(history.latest_states(df.repartition(5), IDENTITY)) == rows(once)


@pytest.mark.parametrize("seed", SEEDS)
def test_transition_against_python(spark, seed):
    rng = random.Random(seed)
    users = [f"u{i}" for i in range(120)]
    state = [
        (u, u, None, None, rng.choice([0, 1, 2]), maybe(rng, [RUN_DATE - dt.timedelta(days=k) for k in (0, 29, 30, 31, 90)]), None, maybe(rng, [True, False, False]), D0)
        for u in users + [None]
    ]
    known = [(u, rng.random() < 0.6, maybe(rng, ["g1", "g2", "g1, g3", " , ", "g3"]), None, D0) for u in rng.sample(users, 90)]
    empty = rng.sample(users, 20) + [None]
    listed = {"g1", "g9"}

    def expected(row):
        user, status, flag, override = row[0], row[4], row[5], row[7]
        hit = next((k for k in known if k[0] == user), None)
        groups = {g.strip() for g in ((hit and hit[2]) or "").split(",")} & listed
        if override:
            return 0, None
        if user in empty:
            return 2, RUN_DATE
        if status == 0 and hit is not None:
            return (0, None) if hit[1] and groups else (1, RUN_DATE)
        if status == 1 and flag and (RUN_DATE - flag).days >= 30:
            return 2, flag
        return status, flag

    facts = lifecycle.account_facts(
        spark.createDataFrame(known, "username string, entra_status boolean, groups string, directory_id string, updated_date date"),
        spark.createDataFrame([(u,) for u in empty], "username string"),
        spark.createDataFrame([(g,) for g in listed], "id string"),
    )
    frame = spark.createDataFrame(state, STATE.schema)
    moved = lifecycle.transition(frame, facts, RUN_DATE)
    got = {r.username: (r.delete_status, r.flag_date) for r in moved.collect()}
    assert got == {row[0]: expected(row) for row in state}
    assert moved.count() == len(state)


@pytest.mark.parametrize("seed", SEEDS)
def test_resolution_against_python(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(15)]

    def address(share=0.2):
        name = maybe(rng, names, share)
        return name and rng.choice([name, name.upper(), f" {name}"]) + rng.choice(["@d", "@x"])

    people = [(str(i), address(), address(), [m for m in (address() for _ in range(rng.randrange(3)))], None, None, i) for i in range(25)]
    accounts = [(maybe(rng, names), address(), str(i)) for i in range(80)]

    def key(a):
        return a.strip().lower()

    principal, other = {}, {}
    for person in people:
        for a in person[1:3]:
            if a:
                principal.setdefault(key(a), person)
        for a in person[3]:
            if a:
                other.setdefault(key(a), person)

    def expected(username, email):
        def local(a):
            return (a or "").split("@")[0] + "@d"

        tried = list(dict.fromkeys(a for a in (email, local(username), local(email)) if a and a.strip()))
        alternate = next((other[key(a)][1] for a in tried if key(a) in other and other[key(a)][1]), None)
        if alternate and alternate.lower() not in [a.lower() for a in tried]:
            tried.append(alternate)
        used = next((a for a in tried if key(a) in principal), None)
        return ", ".join(tried), used, used and principal[key(used)][0]

    status = identity.identity_status(
        spark.createDataFrame(accounts, "username string, email string, name string"),
        spark.createDataFrame(people, USERS),
        spark.createDataFrame([], MANAGERS),
        spark.createDataFrame([], GROUPS),
        RUN_DATE, "", "d",
    )
    got = {r.name: (r.emails_tried, r.working_email, r.directory_id) for r in status.collect()}
    assert got == {name: expected(username, email) for username, email, name in accounts}


@pytest.mark.parametrize("seed", SEEDS)
def test_contacts_against_python(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice("ab"), maybe(rng, ["m1", " m1", "m2 ", "", " ", "m3"]), k) for k in range(60)]
    rng.shuffle(data)
    want = {}
    for user, value, _ in sorted(data, key=lambda r: r[2]):
        if value and value.strip():
            want.setdefault(user, {})[value.strip()] = True
    df = spark.createDataFrame(data, "username string, v string, pos int").repartition(3)
    got = dict(rows(contacts.ordered_distinct(df, "username", "v", ["pos"], "list")))
    assert got == {user: list(seen) for user, seen in want.items()}


@pytest.mark.parametrize("seed", SEEDS)
def test_quota_against_python(spark, seed):
    rng = random.Random(seed)
    people = [(maybe(rng, "abcdef"), rng.choice("pq"), "n") for _ in range(12)]
    things = [(maybe(rng, "abcdefgh"), maybe(rng, [1.25, 40.5, 7.0])) for _ in range(80)]
    want = {}
    for person in people:
        sizes = [s for o, s in things if person[0] is not None and o == person[0] and s is not None]
        if sizes:
            want[person] = want.get(person, 0) + sum(sizes)
    report = quota.over_quota(
        spark.createDataFrame(people, "username string, email string, name string"),
        spark.createDataFrame(things, "owner string, feature_storage_size double"),
        150,
    )
    assert {tuple(r)[:3]: r[3] for r in report.collect()} == {k: v for k, v in want.items() if v > 150}


def test_hot_keys_give_the_same_as_even_ones(spark):
    """A third of the rows under one key: the results are those of plain SQL."""
    base = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("owner"),
        F.when(F.col("id") % 97 != 0, F.col("id").cast("string")).alias("item_id"),
        (F.col("id") % 11).cast("double").alias("feature_storage_size"),
        (F.col("id") % 50).cast("int").alias("pos"),
    )
    base.createOrReplaceTempView("things")
    members = base.select(F.col("owner").alias("username")).distinct().withColumn("email", F.lit("e")).withColumn("name", F.lit("n"))
    assert rows(quota.over_quota(members, base, 400), "username", "total_feature_storage_mb") == rows(
        spark.sql("select owner, sum(feature_storage_size) from things group by owner having sum(feature_storage_size) > 400")
    )
    assert rows(lifecycle.users_without_items(members, base)) == rows(spark.sql("select distinct owner from things where item_id is null"))
    joined = identity.joined_in_order(base.where("item_id is not null"), "owner", "item_id", ["pos"], 40)
    assert rows(joined) == rows(
        spark.sql(
            "select owner, substr(array_join(transform(array_sort(collect_list(struct(pos, item_id))), x -> x.item_id), ', '), 1, 40) "
            "from things where item_id is not null group by owner"
        )
    )
