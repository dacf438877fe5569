"""Where the jobs keep their tables: dated snapshots, histories and versioned tables, all Parquet.

Every writing has a folder of its own that is never changed, and a record under ``commits`` once its job has finished;
readers take the newest writing on record. So a job that dies, or an executor that is lost in the middle, leaves what was
before in force, and nothing is dropped before its successor exists. Two jobs at a time are told apart by their records: of
the same name there is only one, whoever is later gets an error and has changed nothing. The records are the store's own: it does not matter
whether the cluster writes ``_SUCCESS`` files. Tables with data but without any record are an error, not an empty table.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rosterkeep.model import KINDS
from rosterkeep.operators.history import whole_history
from rosterkeep.sources import paths

VERSION = "version="
SNAPSHOT = "snapshot_date="
WRITING = "writing="
RECORD = "what string, name string, path string"
PART = "part="
#: So many parts of a tier become one of the next.
FANOUT = 4


class NoTable(FileNotFoundError):
    """A table or snapshot that was not written yet."""


class LostRecords(RuntimeError):
    """There are data, but no record of a finished writing."""


class ConcurrentWrite(RuntimeError):
    """Another job wrote the same table, snapshot or history at the same time, and was first."""


class AlreadyFolded(RuntimeError):
    """A snapshot whose date is in the history can't be written again."""


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema; Spark drops the branches of a plan that read it."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass(frozen=True)
class Part:
    """A part of a history: what the folds from ``first`` to ``last`` gave."""

    last: int
    tier: int
    first: int

    @property
    def name(self) -> str:
        return f"{self.last:06d}" if self.tier == 0 else f"{self.last:06d}-{self.tier}-{self.first:06d}"

    @staticmethod
    def of(name: str) -> Part:
        numbers = [int(n) for n in name.split("-")]
        return Part(*numbers) if len(numbers) == 3 else Part(numbers[0], 0, numbers[0])

    def covers(self, other: Part) -> bool:
        return self.tier > other.tier and self.first <= other.first and other.last <= self.last


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    # --- Records of finished writings ---

    def commits_path(self, what: str) -> str:
        return f"{self.root}/commits/{what}"

    def commit(self, what: str, name: str, path: str) -> None:
        """Put a writing into force; of two that would have the same name only one can."""
        record = {"what": what, "name": name, "path": path.removeprefix(f"{self.root}/")}
        try:
            paths.write_text(self.spark, f"{self.commits_path(what)}/{name}.json", json.dumps(record))
        except FileExistsError as error:
            raise ConcurrentWrite(f"{what} {name} was written by another job meanwhile") from error

    def committed(self, what: str) -> list[str]:
        """Names on record, in order; one listing."""
        return [name for name, _ in self._records(what)]

    def _records(self, what: str) -> list[tuple[str, dt.datetime]]:
        found = paths.entries(self.spark, self.commits_path(what))
        return [(n.removesuffix(".json"), at) for n, at in found if n.endswith(".json") and not n.startswith(".")]

    def recorded_path(self, what: str, name: str) -> str:
        return f"{self.root}/{json.loads(paths.read_text(self.spark, f'{self.commits_path(what)}/{name}.json'))['path']}"

    def _lost(self, folder: str) -> None:
        """An error if a folder without records has finished data below it."""
        for name in paths.names(self.spark, folder):
            if paths.data_files(self.spark, f"{folder}/{name}"):
                raise LostRecords(f"{folder}/{name} has data, but {self.root}/commits has no record of them")

    # --- Snapshots ---

    def write_snapshot(self, kind: str, date: dt.date, df: DataFrame, judge: Callable[[], None] | None = None) -> str:
        """A snapshot of a date; written again it is a new writing, which counts from then on.

        ``judge`` runs when the rows are written; if it raises, they do not come into force. A date that is in the history
        stays as it is: its states could not be taken out again.
        """
        if date.isoformat() in self._folded(kind):
            raise AlreadyFolded(f"{kind} of {date} is in the history")
        earlier = [n.split(".")[1] for n in self.committed(f"snapshots-{kind}") if n.startswith(f"{date.isoformat()}.")]
        number = 1 + int(max(earlier, default=0))
        path = f"{self.root}/snapshots/{kind}/{SNAPSHOT}{date.isoformat()}/{WRITING}{number:06d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        if judge:
            judge()
        self.commit(f"snapshots-{kind}", f"{date.isoformat()}.{number:06d}", path)
        return path

    def _writings(self, kind: str) -> dict[dt.date, str]:
        """The newest writing of each date."""
        found = self.committed(f"snapshots-{kind}")
        if not found:
            for date in paths.names(self.spark, f"{self.root}/snapshots/{kind}"):
                self._lost(f"{self.root}/snapshots/{kind}/{date}")
        return {dt.date.fromisoformat(n.split(".")[0]): n.split(".")[1] for n in found}

    def snapshot_dates(self, kind: str) -> list[dt.date]:
        """Dates with a finished snapshot."""
        return sorted(self._writings(kind))

    def snapshot_path(self, kind: str, date: dt.date, writing: str) -> str:
        return self.recorded_path(f"snapshots-{kind}", f"{date.isoformat()}.{writing}")

    def snapshot(self, kind: str, date: dt.date | None = None) -> DataFrame:
        """One snapshot, the newest by default."""
        writings = self._writings(kind)
        if not writings or (date and date not in writings):
            raise NoTable(f"no snapshot of {kind}" + (f" for {date}" if date else ""))
        date = date or max(writings)
        return self.spark.read.parquet(self.snapshot_path(kind, date, writings[date]))

    def newest_path(self, kind: str) -> str:
        """Where the newest snapshot is."""
        writings = self._writings(kind)
        return self.snapshot_path(kind, max(writings), writings[max(writings)])

    def snapshots(self, kind: str, dates: Iterable[dt.date]) -> DataFrame:
        """Several snapshots in one scan, in the kind's columns."""
        writings = self._writings(kind)
        return self.spark.read.schema(KINDS[kind].schema).parquet(*[self.snapshot_path(kind, d, writings[d]) for d in dates])

    def _folded(self, kind: str) -> set[str]:
        return {name for name, _ in self._fold_marks(kind)}

    def _fold_marks(self, kind: str) -> list[tuple[str, dt.datetime]]:
        found = paths.entries(self.spark, f"{self.root}/folded/{kind}")
        return [(name[len(SNAPSHOT):], at) for name, at in found if name.startswith(SNAPSHOT)]

    def pending_dates(self, kind: str) -> list[dt.date]:
        """Snapshot dates that are not in the history yet."""
        done = self._folded(kind)
        return [date for date in self.snapshot_dates(kind) if date.isoformat() not in done]

    def mark_folded(self, kind: str, dates: Iterable[dt.date]) -> None:
        """Note which snapshots a history version holds. Called after it is written; folding twice is harmless."""
        for date in dates:
            paths.make_folder(self.spark, f"{self.root}/folded/{kind}/{SNAPSHOT}{date.isoformat()}")

    # --- History ---
    #
    # Each fold gives a part of tier 0, which is never changed. ``FANOUT`` parts of a tier, one after the other, are summed
    # up as one of the next tier, which is in force instead of them. Of the last part all rows count, of the others the
    # closed ones. A state may be in several parts; within a part of a higher tier it is there once.

    def _all_parts(self, kind: str) -> list[Part]:
        done = self.committed(f"history-{kind}")
        if not done:
            for name in paths.names(self.spark, f"{self.root}/history/{kind}"):
                self._lost(f"{self.root}/history/{kind}/{name}")
        return [Part.of(name) for name in done]

    def parts(self, kind: str) -> list[Part]:
        """The parts in force, in order."""
        every = self._all_parts(kind)
        return sorted((p for p in every if not any(q.covers(p) for q in every)), key=lambda p: p.last)

    def _write_part(self, kind: str, rows: DataFrame, part: Part) -> None:
        path = f"{self.root}/history/{kind}/{PART}{part.name}-{uuid.uuid4().hex[:8]}"
        rows.write.partitionBy("open").parquet(path)
        self.commit(f"history-{kind}", part.name, path)

    def _rows(self, kind: str, parts: list[Part], last: Part) -> DataFrame:
        """Rows of some parts, each with ``open``: all of ``last``, of others the closed ones.

        The flag is a directory, so open rows that do not count are not read.
        """
        schema = T.StructType([*KINDS[kind].schema.fields, T.StructField("open", T.BooleanType())])
        found = {p: self.recorded_path(f"history-{kind}", p.name) for p in parts}
        closed = [f"{path}/open=false" for path in found.values() if paths.exists(self.spark, f"{path}/open=false")]
        frames = []
        for flag, folders in ((False, closed), (True, [f"{found[last]}/open=true"] if last in found else [])):
            folders = [f for f in folders if paths.exists(self.spark, f)]
            if folders:
                rows = self.spark.read.schema(T.StructType(schema.fields[:-1])).parquet(*folders)
                frames.append(rows.withColumn("open", F.lit(flag)))
        return reduce(DataFrame.unionByName, frames) if frames else empty_frame(self.spark, schema)

    def open_states(self, kind: str) -> DataFrame | None:
        """States of the newest snapshot folded; None before the first fold."""
        parts = self.parts(kind)
        return self._rows(kind, parts[-1:], parts[-1]).where("open").drop("open") if parts else None

    def add_fold(self, kind: str, folded: DataFrame) -> None:
        """Write the next part. Of two folds at a time one raises ``ConcurrentWrite``; its snapshots stay pending."""
        parts = self.parts(kind)
        number = parts[-1].last + 1 if parts else 1
        self._write_part(kind, folded, Part(number, 0, number))

    def history(self, kind: str, match: str = "binary") -> DataFrame:
        """Every distinct state with the latest date it was seen; empty before the first fold.

        Where a single part is in force, as after ``compact_history(whole=True)``, that is its rows, read without a shuffle.
        """
        parts = self.parts(kind)
        if not parts:
            return empty_frame(self.spark, KINDS[kind].schema)
        rows = self._rows(kind, parts, parts[-1])
        if len(parts) > 1:
            rows = whole_history(rows, KINDS[kind], match)
        return rows.drop("open")

    def compact_history(self, kind: str, match: str = "binary", whole: bool = False) -> list[Part]:
        """Sum up ``FANOUT`` newest parts of one tier, and so on with the next one; or all parts as one (H6).

        A tier's parts are about ``FANOUT`` times those of the tier below, so a row is rewritten once a tier however long
        the history grows. Returns the parts written.
        """
        written = []
        while parts := self.parts(kind):
            if whole:
                merged = parts
            else:
                merged = next((run for run in _runs(parts) if len(run) >= FANOUT), [])
            if len(merged) < 2:
                break
            tier = 1 + max(p.tier for p in merged)
            rows = whole_history(self._rows(kind, merged, parts[-1]), KINDS[kind], match)
            part = Part(merged[-1].last, tier, merged[0].first)
            self._write_part(kind, rows, part)
            written.append(part)
        return written

    # --- Versioned tables ---

    def current_version(self, table: str) -> int | None:
        done = self.committed(f"table-{table}")
        if not done:
            self._lost(f"{self.root}/tables/{table}")
        return int(done[-1]) if done else None

    def has(self, table: str) -> bool:
        return self.current_version(table) is not None

    def read(self, table: str) -> DataFrame:
        """The current version."""
        version = self.current_version(table)
        if version is None:
            raise NoTable(f"no table {table}")
        return self.spark.read.parquet(self.version_path(table, version))

    def version_path(self, table: str, version: int) -> str:
        return self.recorded_path(f"table-{table}", f"{version:06d}")

    def replace(self, table: str, df: DataFrame, base: int | None = None) -> DataFrame:
        """Write the next version and read it back (S6). The frame may read the current version.

        ``base`` is the version the frame was made from, by default the current one. If another job puts a version after
        it into force first, this one raises ``ConcurrentWrite`` and changes nothing; nobody waits for a lock.
        """
        version = 1 + (base if base is not None else int(max(self.committed(f"table-{table}"), default=0)))
        path = f"{self.root}/tables/{table}/{VERSION}{version:06d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        self.commit(f"table-{table}", f"{version:06d}", path)
        return self.spark.read.parquet(path)

    # --- Expiry ---

    def expire(self, before: dt.datetime) -> list[str]:
        """Drop what was no longer in force at ``before``, and what was left behind by jobs that failed until then.

        That is: older versions of tables, writings of a snapshot that were replaced, snapshots that are in the history (but
        the newest of each kind, and their dates stay folded), parts of a history that were summed up, and data without a
        record. A reader that began later than ``before`` misses nothing; one that runs longer than the keep period may.
        The record goes first and the data after it, so a job that dies in between leaves only what the next one drops.
        Returns the paths dropped.
        """
        gone: list[str] = []
        for what in paths.names(self.spark, f"{self.root}/commits"):
            for name, at in self._out_of_force(what).items():
                if at < before:
                    path = self.recorded_path(what, name)
                    paths.delete(self.spark, f"{self.commits_path(what)}/{name}.json")
                    paths.delete(self.spark, path)
                    gone.append(path)
        return gone + self._drop_orphans(before)

    def _out_of_force(self, what: str) -> dict[str, dt.datetime]:
        """Names on record that are no longer in force, and since when."""
        records = self._records(what)
        written = dict(records)
        if what.startswith("history-"):
            parts = [Part.of(name) for name in written]
            return {p.name: min(written[q.name] for q in parts if q.covers(p)) for p in parts if any(q.covers(p) for q in parts)}
        if what.startswith("table-"):
            return {name: at for (name, _), (_, at) in zip(records, records[1:])}
        folded = dict(self._fold_marks(what.removeprefix("snapshots-")))
        out = {}
        for i, (name, _) in enumerate(records):
            date = name.split(".")[0]
            after = records[i + 1] if i + 1 < len(records) else None
            if after and after[0].startswith(f"{date}."):
                out[name] = after[1]
            elif after and date in folded:
                out[name] = folded[date]
        return out

    def _drop_orphans(self, before: dt.datetime) -> list[str]:
        """Data of writings that never came into force, last touched before a time."""
        known = {self.recorded_path(what, n) for what in paths.names(self.spark, f"{self.root}/commits") for n in self.committed(what)}
        gone = []
        for area, depth in (("tables", 1), ("history", 1), ("snapshots", 2)):
            folders = [f"{self.root}/{area}"]
            for _ in range(depth):
                folders = [f"{folder}/{name}" for folder in folders for name in paths.names(self.spark, folder)]
            for folder in folders:
                for name, at in paths.entries(self.spark, folder):
                    if f"{folder}/{name}" not in known and at < before:
                        paths.delete(self.spark, f"{folder}/{name}")
                        gone.append(f"{folder}/{name}")
        return gone

    # --- Reports ---

    def report_path(self, name: str) -> str:
        return f"{self.root}/reports/{name}"


def _runs(parts: list[Part]) -> list[list[Part]]:
    """Parts of the same tier that follow each other, the newest ones first."""
    return [list(run) for _, run in groupby(parts, key=lambda p: p.tier)][::-1]


def typed_scan(spark: SparkSession, path: str, kind: str, columns: Iterable[str] | None = None) -> DataFrame:
    """A kind's Parquet table by column name, missing columns NULL; only the columns asked for are read."""
    df = spark.read.schema(KINDS[kind].schema).parquet(path)
    return df.select(*columns) if columns else df
