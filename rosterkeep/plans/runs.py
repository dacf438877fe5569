"""The steps of a run over a store: catalogue, lifecycle, delete list, quota report, notifications."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterkeep.functions.typing import DATE_FORMATS, apply_types
from rosterkeep.model import (
    DELETE_LIST,
    DELETE_LIST_NAME,
    ERROR_LIST_NAME,
    IDENTITY,
    ITEMS,
    KINDS,
    MEMBERS,
    Layout,
    OVER_QUOTA,
    OVER_QUOTA_NAME,
    STATE,
    TITLE_MARKS,
)
from rosterkeep.operators import contacts, history, identity as ids, lifecycle, notify, quota
from rosterkeep.operators.notify import Template
from rosterkeep.plans.counts import RunCounts, rows_counted, rule_metrics
from rosterkeep.session import sized_shuffles
from rosterkeep.sources import paths, reports
from rosterkeep.sources.store import Store, empty_frame
from rosterkeep.sources.templates import DEFAULT_TEMPLATES


@dataclass(frozen=True)
class RunConfig:
    """Everything a run depends on; there is no clock and no environment in it."""

    run_date: dt.date
    address_suffix: str
    address_domain: str
    quota_mb: float
    grace_days: int = 30
    match: str = "binary"
    legacy_truncate: bool = False
    #: The groups of a user are in the identity state as a digest, and dated memberships beside it; only reports have their
    #: text. Without it, and with ``legacy_truncate``, the state has the text.
    group_digest: bool = True
    date_formats: Sequence[str] = DATE_FORMATS
    na_tokens: Sequence[str] = ()
    multi_line: bool = True
    line_sep: str | None = None
    #: So many malformed rows of a report are listed and left out; with more the report is not taken in.
    max_malformed: int = 0
    templates: Mapping[str, Template] = field(default_factory=lambda: DEFAULT_TEMPLATES)


@dataclass(frozen=True)
class Directory:
    """Exports of the directory."""

    users: DataFrame
    manager_edges: DataFrame
    group_edges: DataFrame
    whitelist: DataFrame


#: The table of every manager address a user ever had, with the date it was first seen.
CONTACTS = "contacts"


def fold_history(store: Store, config: RunConfig, kind: str, counts: RunCounts | None = None) -> list[dt.date]:
    """Take every earlier snapshot that is pending into the history of a kind, in one pass (H2, H6).

    Snapshots of the run date itself wait, so a run can be repeated on its date. With the identities the table of contacts is
    brought up to date; a fold that is run again changes neither.
    """
    pending = [date for date in store.pending_dates(kind) if date < config.run_date]
    if pending:
        layout = KINDS[kind]
        opened = store.open_states(kind)
        if opened is None:
            opened = empty_frame(store.spark, layout.schema)
        arrived = store.snapshots(kind, pending)
        folded = history.fold_open(opened, [arrived], layout, config.match)
        store.add_fold(kind, _counted(counts, folded, f"fold {kind}", states=rows_counted(), open=F.count_if("open")))
        if kind == "identity":
            known = store.read(CONTACTS) if store.has(CONTACTS) else None
            store.replace(CONTACTS, contacts.first_seen(known, arrived, "username", "manager_email", "updated_date"))
        store.mark_folded(kind, pending)
    return pending


def _counted(counts: RunCounts | None, df: DataFrame, step: str, **metrics: Column) -> DataFrame:
    return counts.observe(df, step, **metrics) if counts else df


class TooManyMalformed(ValueError):
    """A report with more malformed rows than the run allows."""


def take_in(store: Store, config: RunConfig, layout: Layout, path: str, counts: RunCounts | None = None) -> None:
    """One report as the snapshot of the run date.

    Malformed rows are counted while the snapshot is written and listed with file and line; if there are more than
    ``max_malformed``, the snapshot does not come into force. Rows with unreadable values are in it, and listed besides.
    """
    rows = reports.read_rows(store.spark, path, layout, config.multi_line, config.line_sep)
    wrong = F.col(reports.MALFORMED).isNotNull()
    seen = RunCounts()
    # Counted between cutting and typing: one stage of generated code for both would be too long for the JVM to compile.
    whole = seen.observe(rows, layout.name, rows=F.count_if(~wrong), malformed=F.count_if(wrong)).where(~wrong).drop(reports.MALFORMED)
    typed = reports.typed_rows(whole, layout, config.run_date, config.date_formats, config.na_tokens, note_unreadable=True)
    read = seen.observe(typed, layout.name, unreadable=F.count_if(F.size("unreadable") > 0))

    def judge() -> None:
        malformed = {name: value for _, name, value in seen.rows()}["malformed"]
        if malformed:
            listed = store.report_path(reports.dated_name(f"malformed_{layout.name}", config.run_date))
            reports.write_csv(reports.malformed_rows(rows), listed)
            if malformed > config.max_malformed:
                raise TooManyMalformed(f"{malformed} malformed rows in {path}, listed in {listed}")

    store.write_snapshot(layout.name, config.run_date, read, judge)
    if counts:
        counts.add(seen)
    written = store.snapshot(layout.name, config.run_date)
    listed = written.where(F.size("unreadable") > 0).withColumn("unreadable", F.concat_ws("; ", "unreadable"))
    reports.write_csv(listed, store.report_path(reports.dated_name(f"unreadable_{layout.name}", config.run_date)), layout)
    reports.write_csv(
        written.drop("unreadable"), store.report_path(reports.dated_name(TITLE_MARKS[layout.name], config.run_date)), layout
    )


#: What the last resolution went by: the index of addresses, the users' profiles, and for which snapshot and settings.
INDEX, PROFILES, RESOLVED = "directory_index", "directory_profiles", "resolved"


def _resolved_before(store: Store, settings: str) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Index and profiles that the newest identity snapshot was made by, and that snapshot; None if that is not known."""
    if not store.snapshot_dates("identity") or not store.has(RESOLVED):
        return None
    row = store.read(RESOLVED).first()
    if (row["path"], row["settings"]) != (store.newest_path("identity"), settings):
        return None
    wanted = {INDEX: row["index"], PROFILES: row["profiles"]}
    if any(f"{version:06d}" not in store.committed(f"table-{table}") for table, version in wanted.items()):
        return None
    return *[store.spark.read.parquet(store.version_path(t, v)) for t, v in wanted.items()], store.snapshot("identity")


def resolve_members(store: Store, config: RunConfig, directory: Directory, counts: RunCounts | None = None) -> None:
    """Identity status of the current members as the snapshot of the run date.

    The directory's index and the users' profiles are kept. If the newest identity snapshot was made by them, only accounts
    that are new, or that a difference between the two listings touches, are resolved again; the others keep their row. The
    result is the same as that of resolving everybody.
    """
    members = store.snapshot("members", config.run_date)
    args = (config.run_date, config.address_suffix, config.address_domain, config.legacy_truncate)
    digest = config.group_digest and not config.legacy_truncate
    settings = f"{config.address_suffix} {config.address_domain} {config.legacy_truncate} {digest}"
    before = _resolved_before(store, settings)
    index = store.replace(INDEX, ids.resolution_index(directory.users))
    group_edges = directory.group_edges
    if digest:
        # Read back below, so the export is parsed once.
        store.write_snapshot("memberships", config.run_date, reports.stamp(group_edges.select("user_id", "group_id", "pos"), config.run_date))
        group_edges = store.snapshot("memberships", config.run_date)
    profiles = ids.user_profiles(directory.users, directory.manager_edges, group_edges, config.legacy_truncate, digest)
    profiles = store.replace(PROFILES, profiles)
    if before:
        addresses = ids.changed_keys(before[0], index, ["key", "led"])
        users = ids.changed_keys(before[1], profiles, ["user_id"])
        # The profiles of users that no difference touches are as before, so kept rows take them from the same table.
        previous = before[2].drop(*ids.OF_PROFILE)
        again, kept = ids.split_affected(members, previous, addresses, users, config.address_suffix, config.address_domain)
        anew = ids.found_rows(again, index, *args).withColumn("_anew", F.lit(True))
        kept = kept.withColumns({"updated_date": F.lit(config.run_date).cast("date"), "_anew": F.lit(False)})
        found = anew.unionByName(kept.select(*anew.columns))
    else:
        found = ids.found_rows(members, index, *args).withColumn("_anew", F.lit(True))
    status = ids.with_profiles(found, profiles)
    metrics = {"rows": rows_counted(), "found": F.count_if("entra_status"), "errors": F.count_if(ids.is_error()), "resolved": F.count_if("_anew")}
    path = store.write_snapshot("identity", config.run_date, _counted(counts, status, "identity", **metrics).drop("_anew"))
    by = (path, settings, store.current_version(INDEX), store.current_version(PROFILES))
    store.replace(RESOLVED, store.spark.createDataFrame([by], "path string, settings string, index int, profiles int"))
    written = store.snapshot("identity", config.run_date)
    shown = ids.with_group_text(written, group_edges) if digest else written
    reports.write_csv(
        shown.select(*IDENTITY.columns), store.report_path(reports.dated_name(TITLE_MARKS["identity"], config.run_date)), IDENTITY
    )
    reports.write_csv(
        ids.error_rows(written).select("username"), store.report_path(reports.dated_name(ERROR_LIST_NAME, config.run_date))
    )


def catalogue(store: Store, config: RunConfig, report_folder: str, directory: Directory, counts: RunCounts | None = None) -> None:
    """Fold the earlier snapshots, take in the newest reports, resolve the members to directory users."""
    for kind in KINDS:
        fold_history(store, config, kind, counts)
    newest = reports.latest_report_paths(reports.manifest(store.spark, report_folder), ["items", "members"])
    for layout in (ITEMS, MEMBERS):
        take_in(store, config, layout, newest[layout.name], counts)
    resolve_members(store, config, directory, counts)


def update_state(store: Store, config: RunConfig, directory: Directory, counts: RunCounts | None = None) -> DataFrame:
    """Add new accounts, move every account by the rules, write the new state. Returns the counts by rule.

    The moves are written once and read back for the state and the counts, so nothing is computed twice.
    """
    identity = store.snapshot("identity", config.run_date)
    state = store.read("state") if store.has("state") else empty_frame(store.spark, STATE.schema)
    state = state.select(*STATE.columns, F.lit(False).alias("_new")).unionByName(
        lifecycle.new_accounts(identity, state, config.run_date).withColumn("_new", F.lit(True))
    )
    facts = lifecycle.account_facts(
        identity,
        lifecycle.users_without_items(store.snapshot("members", config.run_date), store.snapshot("items", config.run_date), config.match),
        directory.whitelist,
        None if config.legacy_truncate else directory.group_edges,
    )
    moved = lifecycle.transition(state, facts, config.run_date, config.grace_days, keep=("empty",))
    metrics = {"accounts": rows_counted(), "new": F.count_if("_new"), "empty": F.count_if("empty")} | rule_metrics()
    moved = store.replace("moves", _counted(counts, moved, "state", **metrics).drop("_new", "empty"))
    store.replace("state", moved.select(*STATE.columns))
    return lifecycle.rule_counts(moved)


def write_delete_list(store: Store, config: RunConfig, counts: RunCounts | None = None) -> str:
    """Sorted names of the accounts to delete, as CSV (L2)."""
    path = store.report_path(reports.dated_name(DELETE_LIST_NAME, config.run_date))
    listed = _counted(counts, lifecycle.delete_list(store.read("state")), "delete list", rows=rows_counted())
    return reports.write_csv(listed, path, DELETE_LIST)


def write_over_quota(store: Store, config: RunConfig, counts: RunCounts | None = None) -> str:
    """Owners above the quota, largest first, as CSV."""
    report = quota.over_quota(
        store.snapshot("members", config.run_date), store.snapshot("items", config.run_date), config.quota_mb, config.match
    )
    path = store.report_path(reports.dated_name(OVER_QUOTA_NAME, config.run_date))
    return reports.write_csv(_counted(counts, report, "over quota", rows=rows_counted()), path, OVER_QUOTA)


def read_over_quota(store: Store) -> DataFrame:
    """The newest over-quota report."""
    path = reports.newest_dated_path(store.spark, f"{store.root}/reports", OVER_QUOTA_NAME)
    raw = reports.read_text_columns(store.spark, path, OVER_QUOTA, multi_line=True)
    return apply_types(raw, OVER_QUOTA)


def queue_notifications(store: Store, config: RunConfig) -> DataFrame:
    """Write the queue of messages for the current state and the newest quota report, and what it counts.

    The addresses in copy come from the table of contacts, which each fold of identities keeps up to date; the history is
    not read.
    """
    known = store.read(CONTACTS) if store.has(CONTACTS) else empty_frame(store.spark, IDENTITY.schema)
    queue = notify.notification_queue(store.read("state"), known, read_over_quota(store), config.templates, config.quota_mb)
    counts = RunCounts()
    metrics = {kind: F.count_if(F.col("kind") == kind) for kind in (*notify.STATUS_KINDS, notify.QUOTA_KIND)}
    metrics |= {"skipped": F.count("skip_reason"), "copies": F.sum("cc_count")}
    written = store.replace("notifications", counts.observe(queue, "notifications", **metrics))
    counts.write(store, config.run_date)
    return written


def override(store: Store, requests: DataFrame) -> DataFrame:
    """Set overrides by working address and write the state (L3)."""
    return store.replace("state", lifecycle.apply_overrides(store.read("state"), requests))


def _input_bytes(store: Store, report_folder: str, directory: Directory) -> int:
    """About the bytes a run shuffles at most at once: its reports, the store's snapshots and the directory exports."""
    frames = (directory.users, directory.manager_edges, directory.group_edges)
    exports = sum(paths.size_of(store.spark, path) for df in frames for path in df.inputFiles())
    return paths.size_of(store.spark, report_folder) + paths.size_of(store.spark, f"{store.root}/snapshots") + exports


def full_run(spark: SparkSession, root: str, config: RunConfig, report_folder: str, directory: Directory) -> DataFrame:
    """Catalogue, lifecycle, delete list and quota report, in this order. Returns the counts by rule.

    What every step counted while it wrote is left in the store (``counts.run_counts``).
    """
    store, counts = Store(spark, root), RunCounts()
    with sized_shuffles(spark, _input_bytes(store, report_folder, directory)):
        catalogue(store, config, report_folder, directory, counts)
        if config.group_digest and not config.legacy_truncate:
            directory = replace(directory, group_edges=store.snapshot("memberships", config.run_date))
        by_rule = update_state(store, config, directory, counts)
        write_delete_list(store, config, counts)
        write_over_quota(store, config, counts)
    counts.write(store, config.run_date)
    return by_rule
