"""Two jobs at a time, tiers of the history, and what expires."""

import datetime as dt
import threading

import pytest
from conftest import rows

from rosterkeep.model import IDENTITY
from rosterkeep.operators import history
from rosterkeep.plans import runs
from rosterkeep.plans.bindings import in_layout
from rosterkeep.sources import paths
from rosterkeep.sources.store import FANOUT, ConcurrentWrite, Part, Store
from rosterkeep.streaming import intake  # noqa: F401

EVER = dt.datetime(9999, 1, 1, tzinfo=dt.timezone.utc)


def names(spark, day, *users):
    return in_layout(spark.createDataFrame([(u, day) for u in users], "username string, updated_date date"), IDENTITY)


def fold(spark, store, day, *users):
    store.write_snapshot("identity", day, names(spark, day, *users))
    runs.fold_history(store, runs.RunConfig(dt.date(2030, 1, 1), "_org", "d", 100), "identity")


def files(tmp_path, area):
    return sorted(str(p.relative_to(tmp_path)) for p in (tmp_path / area).rglob("*.parquet"))


def test_one_of_two_replaces_wins(spark, tmp_path):
    """Both began from the same version; the later one raises, and its data are not in force."""
    store = Store(spark, str(tmp_path))
    store.replace("t", spark.range(1))
    base = store.current_version("t")
    results = []
    ready = threading.Barrier(2)

    def write(n):
        frame = store.read("t").union(spark.range(n))
        ready.wait()
        try:
            store.replace("t", frame, base)
            results.append(n)
        except ConcurrentWrite:
            results.append(None)

    jobs = [threading.Thread(target=write, args=(n,)) for n in (10, 20)]
    for job in jobs:
        job.start()
    for job in jobs:
        job.join()
    won = [n for n in results if n]
    assert len(won) == 1 and results.count(None) == 1 and store.read("t").count() == 1 + won[0]
    assert store.current_version("t") == base + 1
    store.replace("t", store.read("t").union(spark.range(1)))
    assert store.read("t").count() == 2 + won[0]


def test_a_record_is_written_once(spark, tmp_path):
    """Many at a time: one succeeds, and what is there is its whole text."""
    path, done = str(tmp_path / "commits" / "x.json"), []

    def write(i):
        try:
            paths.write_text(spark, path, f"text {i} " * 1000)
            done.append(i)
        except FileExistsError:
            pass

    jobs = [threading.Thread(target=write, args=(i,)) for i in range(8)]
    for job in jobs:
        job.start()
    for job in jobs:
        job.join()
    assert len(done) == 1 and paths.read_text(spark, path) == f"text {done[0]} " * 1000
    assert [p.name for p in (tmp_path / "commits").iterdir() if not p.name.endswith(".crc")] == ["x.json"]


def test_concurrent_folds_and_snapshots(spark, tmp_path):
    store, day = Store(spark, str(tmp_path)), dt.date(2026, 1, 1)
    folded = history.fold_open(None, [names(spark, day, "a")], IDENTITY)
    store.add_fold("identity", folded)
    with pytest.raises(ConcurrentWrite):
        store._write_part("identity", folded, Part(1, 0, 1))
    other = Store(spark, str(tmp_path))
    with pytest.raises(ConcurrentWrite):
        store.write_snapshot("identity", day, names(spark, day, "a"), lambda: other.write_snapshot("identity", day, names(spark, day, "b")))
    assert rows(store.snapshot("identity"), "username") == [("b",)]


def test_tiers(spark, tmp_path):
    """Each compaction rewrites one tier; rows of older ones stay as they were written."""
    store = Store(spark, str(tmp_path))
    seen = {}
    for k in range(1, 2 * FANOUT + 2):
        day = dt.date(2026, 1, k)
        users = [f"u{k}", f"u{k % 3}", "always"]
        seen |= dict.fromkeys(users, day)
        before = [p for p in store.parts("identity") if p.tier]
        fold(spark, store, day, *users)
        written = store.compact_history("identity")
        assert [p.tier for p in written] == ([1] if k % FANOUT == 0 else [])
        assert before == [p for p in store.parts("identity") if p.tier][: len(before)]
        assert dict(rows(store.history("identity"), "username", "updated_date")) == seen
        assert rows(store.open_states("identity"), "username") == [(u,) for u in sorted(set(users))]
    assert [(p.first, p.last, p.tier) for p in store.parts("identity")] == [(1, 4, 1), (5, 8, 1), (9, 9, 0)]
    [whole] = store.compact_history("identity", whole=True)
    assert store.parts("identity") == [whole] == [Part(9, 2, 1)]
    plan = store.history("identity")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert dict(rows(store.history("identity"), "username", "updated_date")) == seen
    assert store.compact_history("identity", whole=True) == []


def test_expiry(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for k in range(1, FANOUT + 2):
        fold(spark, store, dt.date(2026, 1, k), "a", f"u{k}")
        store.replace("t", spark.range(k))
        store.compact_history("identity")
    store.write_snapshot("identity", dt.date(2026, 2, 1), names(spark, dt.date(2026, 2, 1), "first"))
    store.write_snapshot("identity", dt.date(2026, 2, 1), names(spark, dt.date(2026, 2, 1), "last"))
    running = store.history("identity"), store.read("t")
    want = [rows(store.history("identity")), rows(store.read("t")), rows(store.snapshot("identity"))]
    # Within the keep period nothing goes, so what runs goes on.
    assert store.expire(dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)) == []
    assert [rows(df) for df in running] == want[:2]
    gone = store.expire(EVER)
    assert len([p for p in gone if "/tables/t/" in p]) == len([p for p in gone if "/tables/contacts/" in p]) == FANOUT and len([p for p in gone if "/history/" in p]) == FANOUT
    assert len([p for p in gone if "/snapshots/" in p]) == FANOUT + 2
    assert [rows(store.history("identity")), rows(store.read("t")), rows(store.snapshot("identity"))] == want
    assert len(store.committed("table-t")) == 1 and store.pending_dates("identity") == [dt.date(2026, 2, 1)]
    # A folded date stays folded, and work goes on.
    with pytest.raises(Exception, match="is in the history"):
        fold(spark, store, dt.date(2026, 1, 1), "x")
    fold(spark, store, dt.date(2026, 2, 2), "a")
    assert store.expire(EVER) and ("a", dt.date(2026, 2, 2)) in rows(store.history("identity"), "username", "updated_date")


def test_failed_writings_expire(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.replace("t", spark.range(3))
    spark.range(5).write.parquet(f"{tmp_path}/tables/t/version=000002-lost")
    assert store.expire(dt.datetime(2000, 1, 1, tzinfo=dt.timezone.utc)) == []
    assert [p.rsplit("/", 1)[1] for p in store.expire(EVER)] == ["version=000002-lost"]
    assert store.read("t").count() == 3 and all("lost" not in f for f in files(tmp_path, "tables"))
