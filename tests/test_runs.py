import datetime as dt
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rosterkeep.model import IDENTITY, ITEMS, MEMBERS
from rosterkeep.plans import runs
from rosterkeep.plans.bindings import in_layout
from rosterkeep.sources import reports
from rosterkeep.sources.directory import GROUPS, MANAGERS, USERS
from rosterkeep.session import sized_shuffles
from rosterkeep.sources.store import AlreadyFolded, LostRecords, Store
from rosterkeep.streaming import intake

FIRST, SECOND = dt.date(2026, 5, 15), dt.date(2026, 6, 15)


def config(day, **more):
    return runs.RunConfig(day, "_org", "d", 100, **more)


@pytest.fixture
def exports(spark):
    users = [("1", "ann@d", "ann@d", None, "Law", None, 1), ("2", "bob@d", "bob@d", None, "Art", None, 2), ("3", "boss@d", "boss@d", None, "Top", None, 3)]
    return runs.Directory(
        spark.createDataFrame(users, USERS),
        spark.createDataFrame([("1", "3"), ("2", "3")], MANAGERS),
        spark.createDataFrame([("1", "staff", 1), ("2", "guests", 1)], GROUPS),
        spark.createDataFrame([("staff", "Staff")], "id string, name string"),
    )


def deliver(folder, day, owners):
    """Reports of a day: four members, the given items (owner, size)."""
    folder.mkdir(exist_ok=True)
    members = "Username,Email,Name\nann_org,ann@d,Ann\nbob_org,,Bob\ngone_org,gone@x,Gone\nidle_org,idle@x,Idle\n"
    (folder / f"OrganizationMembers_{day}.csv").write_text(members)
    lines = [f"Item {i},{i},{owner},{size},5/1/2026" for i, (owner, size) in enumerate(owners)]
    (folder / f"OrganizationItems_{day}.csv").write_text("Title,Item ID,Owner,Feature Storage Size,Date Created\n" + "\n".join(lines) + "\n")
    return str(folder)


def test_two_runs(spark, tmp_path, exports):
    store, root = Store(spark, str(tmp_path / "store")), str(tmp_path / "store")
    owners = [("ann_org", 60), ("ann_org", 70), ("bob_org", 5), ("gone_org", "big")]
    counts = runs.full_run(spark, root, config(FIRST), deliver(tmp_path / "in1", FIRST, owners), exports)
    assert rows(counts) == [("R2", 2, 1), ("R3", 1, 1), ("R4", 0, 1), ("R5", 1, 1)]
    assert rows(store.read("state"), "username", "delete_status", "flag_date", "working_email", "manager_email") == [
        ("ann_org", 0, None, "ann@d", "boss@d"),
        ("bob_org", 1, FIRST, "bob@d", "boss@d"),
        ("gone_org", 1, FIRST, None, None),
        ("idle_org", 2, FIRST, None, None),
    ]
    assert rows(spark.read.option("header", True).csv(store.report_path("UsersToDelete_2026_05_15"))) == [("idle_org",)]
    assert rows(runs.read_over_quota(store)) == [("ann_org", "ann@d", "Ann", 130.0)]
    unreadable = spark.read.option("header", True).csv(store.report_path("unreadable_items_2026_05_15"))
    assert rows(unreadable, "Owner", "unreadable") == [("gone_org", "feature_storage_size: big")]
    assert store.history("items").count() == 0

    # The second run folds the first one's snapshots; the flagged accounts' time is up, one is protected.
    runs.override(store, spark.createDataFrame([("bob@d", True)], "working_email string, override boolean"))
    runs.full_run(spark, root, config(SECOND), deliver(tmp_path / "in2", SECOND, owners + [("idle_org", 1)]), exports)
    assert rows(store.read("moves"), "username", "old_status", "rule", "delete_status") == [
        ("ann_org", 0, "R4", 0), ("bob_org", 1, "R1", 0), ("gone_org", 1, "R7", 2), ("idle_org", 2, "R8", 2),
    ]
    assert store.history("items").count() == 4 and store.history("members").count() == 4
    assert rows(store.history("identity"), "username", "manager_email") == [
        ("ann_org", "boss@d"), ("bob_org", "boss@d"), ("gone_org", None), ("idle_org", None),
    ]
    queue = runs.queue_notifications(store, config(SECOND))
    assert rows(queue, "kind", "username", "recipient", "cc_count") == [
        ("delete", "gone_org", None, 0), ("delete", "idle_org", None, 0), ("quota", "ann_org", "ann@d", 0),
    ]


def test_run_can_be_repeated_on_its_date(spark, tmp_path, exports):
    root, folder = str(tmp_path / "store"), deliver(tmp_path / "in", FIRST, [("ann_org", 1), ("bob_org", 1)])
    store = Store(spark, root)
    runs.full_run(spark, root, config(FIRST), folder, exports)
    first = rows(store.read("state"))
    runs.full_run(spark, root, config(FIRST), folder, exports)
    assert rows(store.read("state")) == first and store.history("items").count() == 0


def test_legacy_truncation(spark, tmp_path, exports):
    root, folder = str(tmp_path / "store"), deliver(tmp_path / "in", FIRST, [("ann_org", 1), ("bob_org", 1)])
    counts = runs.full_run(spark, root, config(FIRST, legacy_truncate=True), folder, exports)
    assert ("R4", 0, 1) in rows(counts)


def test_missing_report(spark, tmp_path, exports):
    (tmp_path / "in").mkdir()
    with pytest.raises(reports.NoReport):
        runs.full_run(spark, str(tmp_path / "store"), config(FIRST), str(tmp_path / "in"), exports)


def arrive(spark, store, day, *names):
    df = spark.createDataFrame([(n, day) for n in names], "username string, updated_date date")
    store.write_snapshot("identity", day, in_layout(df, IDENTITY).drop("groups"))


def test_streaming_intake_takes_each_snapshot_once(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    later = config(dt.date(2026, 3, 1))

    def take(config=later):
        query = intake.fold_new_snapshots(store, config, "identity", str(tmp_path / "marks"))
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)

    arrive(spark, store, dt.date(2026, 1, 1), "a", "b")
    assert take() > 0
    assert take() == 0
    arrive(spark, store, dt.date(2026, 2, 1), "b", "c")
    assert take() > 0
    assert rows(store.history("identity"), "username", "updated_date") == [
        ("a", dt.date(2026, 1, 1)), ("b", dt.date(2026, 2, 1)), ("c", dt.date(2026, 2, 1)),
    ]
    with pytest.raises(AlreadyFolded):
        arrive(spark, store, dt.date(2026, 2, 1), "d")


def test_a_rewritten_date_counts_by_its_last_writing(spark, tmp_path):
    store, day = Store(spark, str(tmp_path / "store")), dt.date(2026, 1, 1)
    for name, run_date in (("first", day), ("last", dt.date(2026, 1, 2))):
        arrive(spark, store, day, name)
        intake.fold_new_snapshots(store, config(run_date), "identity", str(tmp_path / "marks")).awaitTermination()
    assert rows(store.history("identity"), "username") == [("last",)]
    assert rows(store.snapshot("identity"), "username") == [("last",)]


@pytest.mark.parametrize("marker", ["true", "false"])
def test_records_do_not_depend_on_success_files(spark, tmp_path, exports, marker):
    key = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set(key, marker)
    try:
        root, folder = str(tmp_path / "store"), deliver(tmp_path / "in", FIRST, [("ann_org", 1), ("bob_org", 1)])
        runs.full_run(spark, root, config(FIRST), folder, exports)
        store = Store(spark, root)
        runs.override(store, spark.createDataFrame([("bob@d", True)], "working_email string, override boolean"))
        for found in (tmp_path / "store").rglob("*_SUCCESS*"):
            found.unlink()
        assert rows(store.read("state"), "username", "override")[1] == ("bob_org", True)
        # Without the store's own records nothing is taken for empty.
        for found in (tmp_path / "store" / "commits").rglob("*.json*"):
            found.unlink()
        for read in (lambda: store.has("state"), lambda: store.snapshot("members"), lambda: runs.full_run(spark, root, config(SECOND), folder, exports)):
            with pytest.raises(LostRecords):
                read()
    finally:
        hadoop.unset(key)


def test_shuffles_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 1 << 40):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8192"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_drifting_columns_in_the_store(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    day1, day2 = dt.date(2026, 1, 1), dt.date(2026, 2, 1)
    wider = in_layout(spark.createDataFrame([("a", day1)], "username string, updated_date date"), MEMBERS)
    store.write_snapshot("members", day1, wider.withColumn("new", F.lit(1)))
    store.write_snapshot("members", day2, spark.createDataFrame([("b", day2)], "username string, updated_date date"))
    assert runs.fold_history(store, config(dt.date(2026, 3, 1)), "members") == [day1, day2]
    assert runs.fold_history(store, config(dt.date(2026, 3, 1)), "members") == []
    assert store.history("members").columns == MEMBERS.columns
    assert rows(store.history("members"), "username", "updated_date") == [("a", day1), ("b", day2)]


def test_a_run_parses_the_memberships_once(spark, tmp_path, exports):
    seen = spark.sparkContext.accumulator(0)

    def note(group):
        seen.add(1)
        return group

    edges = exports.group_edges.withColumn("group_id", F.udf(note, "string")("group_id"))
    watched = runs.Directory(exports.users, exports.manager_edges, edges, exports.whitelist)
    counts = runs.full_run(spark, str(tmp_path / "store"), config(FIRST), deliver(tmp_path / "in", FIRST, [("ann_org", 1), ("bob_org", 5)]), watched)
    assert rows(counts) == [("R2", 2, 2), ("R4", 0, 1), ("R5", 1, 1)]
    assert seen.value == edges.count()


def test_generated_code_of_an_intake_is_short_enough_to_be_compiled(spark, tmp_path, monkeypatch):
    """HotSpot leaves methods of more than 8000 bytes uncompiled, and reading a report of all columns then takes twice the time."""
    path = reports.write_csv(spark.createDataFrame([("1",)], "item_id string").transform(in_layout, ITEMS).drop("updated_date"), str(tmp_path / "r"), ITEMS)
    written = []
    monkeypatch.setattr(Store, "write_snapshot", lambda self, kind, date, df, judge: written.append(df))
    with pytest.raises(LookupError):  # nothing is read back
        monkeypatch.setattr(Store, "snapshot", lambda *_: {}["none"])
        runs.take_in(Store(spark, str(tmp_path / "store")), config(FIRST), ITEMS, path)
    debug = spark._jvm.org.apache.spark.sql.execution.debug.package
    code = debug.codegenString(written[0]._jdf.queryExecution().executedPlan())
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) <= 8000


def test_tokens_for_missing_values_in_a_run(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Username,Name\nu,NA\nNA,n\n")
    store = Store(spark, str(tmp_path / "store"))
    runs.take_in(store, config(FIRST, na_tokens=["NA"]), MEMBERS, str(tmp_path / "m.csv"))
    assert rows(store.snapshot("members"), "username", "name") == [(None, "n"), ("u", None)]
