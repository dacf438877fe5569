"""One query per operator over the test tables; results in plain types, dates and lists as text."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterkeep.functions import addresses, templates, text as tx, typing as ty
from rosterkeep.model import IDENTITY, ITEMS, MEMBERS, OVER_QUOTA, Field, Layout, kind_column
from rosterkeep.operators import contacts, history, identity, latest, lifecycle, notify, quota
from rosterkeep.operators.keys import mark_listed, missing_from
from rosterkeep.plans import bindings as b, counts, runs
from rosterkeep.plans.bindings import DOMAIN, QUOTA, RUN_DATE, SUFFIX, Tables, text
from rosterkeep.sources import directory, paths, reports
from rosterkeep.sources.store import Store, typed_scan
from rosterkeep.sources.templates import DEFAULT_TEMPLATES, read_templates
from rosterkeep.streaming import intake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Query:
    """Register a query under its name; it gets the tables of a folder."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Tables(spark, folder))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ISO text, arrays joined by a bar."""
    return df.select(
        *[
            F.col(name).cast("string").alias(name)
            if kind == "date"
            else F.array_join(F.col(name), "|").alias(name)
            if kind == "array<string>"
            else F.col(name)
            for name, kind in df.dtypes
        ]
    )


# --- Quota --------------------------------------------------------------------------------------------------------


@query
def over_quota_report(t):
    """J1, A1, P10, O1."""
    return quota.over_quota(b.members(t), b.order_items(t), QUOTA)


@query
def storage_by_owner(t):
    """A1: total per owner."""
    return quota.storage_by_owner(b.order_items(t)).select(
        F.col("_owner").alias("owner"), quota.total_size(F.lit(1)).alias("total_mb")
    )


@query
def over_quota_beyond_decimals(t):
    """Sizes that no decimal holds, infinite ones among them, count too."""
    order = F.col("item_id").cast("long")
    size = F.when(order % 1000 == 1, F.lit(float("inf"))).when(order % 1000 == 2, F.lit(1e23)).when(order % 7 != 0, F.col("feature_storage_size"))
    return quota.over_quota(b.members(t), b.order_items(t).withColumn("feature_storage_size", size), QUOTA)


# --- Scans and sources --------------------------------------------------------------------------------------------


@query
def latest_snapshot(t):
    """Newest event of each type."""
    newest = latest.latest_per_kind(t.events.select("event_type", "ts", "event_id", "user_id", "value"), "event_type", "ts", ["event_id"])
    return newest.select("event_type", "event_id", "user_id", "value")


@query
def newest_snapshot_rows(t):
    """Orders of the newest date."""
    return latest.newest_snapshot(t.orders, "o_orderdate").select("o_orderkey", "o_custkey", "o_totalprice")


@query
def newest_dated_report(t):
    """Orders by report name; those of the last name."""
    named = t.orders.select("o_orderkey", F.concat(F.lit("UsersOverQuota_"), F.date_format("o_orderdate", "yyyy_MM_dd")).alias("report"))
    return latest.newest_snapshot(named, "report")


@query
def pending_snapshots(t):
    """Shipping dates that are no order date yet."""
    shipped = t.lineitem.select(F.to_date("l_shipdate").alias("snapshot_date")).distinct()
    return dates_as_text(missing_from(shipped, t.orders.select(F.to_date("o_orderdate").alias("snapshot_date")), "snapshot_date"))


@query
def report_names(t):
    """Table name and kind of report titles."""
    mark = (
        F.when(F.col("o_orderstatus") == "F", "OrganizationItems_")
        .when(F.col("o_orderstatus") == "O", "OrganizationMembers_")
        .otherwise("Other_")
    )
    title = F.concat(mark, F.date_format("o_orderdate", "yyyy/MM/dd"), F.lit("_"), F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", tx.snapshot_name(title).alias("table_name"), kind_column(title).alias("kind"))


@query
def snapshot_stamp(t):
    """S3: run date on each row."""
    return dates_as_text(reports.stamp(t.supplier.select("s_suppkey", "s_name"), RUN_DATE))


@query
def csv_round_trip(t):
    """Whole texts written as a CSV report and read back, line feeds and quotes included."""
    path = reports.write_csv(t.documents, paths.scratch(t.spark, "csv"))
    back = reports.read_text_columns(t.spark, path)
    return back.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars")
    )


@query
def report_intake(t):
    """Member rows out as a CSV report with its headers, in again typed and stamped."""
    path = reports.write_csv(b.member_rows(t), paths.scratch(t.spark, "members"), MEMBERS)
    back = reports.read_report(t.spark, path, MEMBERS, RUN_DATE)
    return dates_as_text(back.select("username", "role", "login_type", "available_credits", "updated_date"))


@query
def report_parts(t):
    """A report of two part files with the columns in another order, and one more."""
    folder = paths.scratch(t.spark, "parts")
    rows = b.member_rows(t).select("username", "role", "login_type", "updated_date")
    done = F.coalesce(F.col("login_type") == "F", F.lit(False))
    reports.write_csv(rows.where(done).select("login_type", "username"), f"{folder}/a", MEMBERS)
    reports.write_csv(rows.where(~done).select("username", "role", "login_type"), f"{folder}/b", MEMBERS)
    back = reports.read_text_columns(t.spark, [f"{folder}/a", f"{folder}/b"], MEMBERS)
    return back.select("username", "role", "login_type")


@query
def malformed_report_rows(t):
    """Rows of a report with too many or too few fields, among rows whose quoted fields hold line feeds and commas."""
    path = paths.scratch(t.spark, "malformed")
    note = F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(',\n""'), F.col("o_orderstatus"), F.lit('"""'))
    fields = F.concat_ws(",", text("o_orderkey"), note, F.when(F.col("o_custkey") % 11 != 0, text("o_custkey")), F.when(F.col("o_custkey") % 7 == 0, F.lit("more")))
    t.orders.select(fields.alias("value")).withColumn("value", F.concat(F.lit("Username,Name,Email\n"), "value")).write.text(path, lineSep="\n")
    # Each row brings a header line, which only the first of a file is; the others are rows of the right length.
    found = reports.read_rows(t.spark, path, MEMBERS)
    wrong = reports.malformed_rows(found)
    kept = found.where(F.col(reports.MALFORMED).isNull() & (F.col("username") != "Username"))
    return kept.select("username", "name", "email", F.lit("").alias("reason")).unionByName(
        wrong.select(F.substring_index("record", ",", 1).alias("username"), F.col("record").alias("name"), F.lit("").alias("email"), "reason")
    )


@query
def written_reports(t):
    """Quota reports of two dates written, the newest one found and read."""
    folder = paths.scratch(t.spark, "reports")
    for days, limit in ((1, QUOTA), (0, QUOTA / 2)):
        report = quota.over_quota(b.members(t), b.order_items(t), limit)
        reports.write_csv(report, f"{folder}/{reports.dated_name('UsersOverQuota', RUN_DATE + runs.dt.timedelta(days=days))}", OVER_QUOTA)
    newest = reports.read_text_columns(t.spark, reports.newest_dated_path(t.spark, folder, "UsersOverQuota"), OVER_QUOTA)
    return ty.apply_types(newest, OVER_QUOTA).select("username", "email", "name", "total_feature_storage_mb")


def _exported(t, df: DataFrame, name: str) -> str:
    path = paths.scratch(t.spark, name)
    df.write.json(path)
    return path


def _read_directory(t) -> runs.Directory:
    """The directory's exports written as files and read."""
    listed = t.orders.select(text("o_orderkey").alias("id"), F.when(F.col("o_orderpriority") == "1-URGENT", "on the list").alias("name"))
    people = b.directory(t).withColumn("display_name", F.lit("anyone"))
    return runs.Directory(
        directory.read_directory(t.spark, _exported(t, people, "users")),
        directory.read_manager_edges(t.spark, _exported(t, b.manager_edges(t), "managers")),
        directory.read_group_edges(t.spark, _exported(t, b.group_edges(t), "groups")),
        directory.read_whitelist(t.spark, _exported(t, listed.where("name is not null"), "whitelist")),
    )


@query
def directory_exports(t):
    """Users and manager edges from files, as the index and the managers made of them."""
    exports = _read_directory(t)
    found = identity.principal_index(exports.users).join(identity.managers(exports.manager_edges, exports.users), "user_id", "left")
    return found.select("key", "user_id", "department", "manager_email")


@query
def whitelist_export(t):
    """Customers in a whitelisted group, edges and whitelist from files."""
    exports = _read_directory(t)
    people = b.members(t).select("username", F.lit(True).alias("entra_status"), F.col("username").alias("directory_id"), F.lit(RUN_DATE).alias("updated_date"))
    facts = lifecycle.account_facts(people, people.select("username").where("username is null"), exports.whitelist, exports.group_edges)
    return facts.select(F.substring("_user", 2, 20).alias("username"), "whitelisted")


@query
def template_files(t):
    """Templates from files, filled per customer."""
    folder = paths.scratch(t.spark, "templates")
    for kind, template in DEFAULT_TEMPLATES.items():
        paths.write_text(t.spark, f"{folder}/{kind}.txt", f"[{kind}]\n{template.body}")
    report = quota.over_quota(b.members(t), b.order_items(t), QUOTA)
    return notify.quota_notices(report, read_templates(t.spark, folder), QUOTA).select("username", "subject", "body")


@query
def projected_scan(t):
    """A kind's table by name, missing columns NULL."""
    path = paths.scratch(t.spark, "scan")
    b.identity_rows(t).drop("groups").write.parquet(path)
    return typed_scan(t.spark, path, "identity", ["username", "manager_email", "groups"])


@query
def versioned_table(t):
    """A table replaced by a version computed from itself."""
    store = Store(t.spark, paths.scratch(t.spark, "store"))
    store.replace("state", b.state(t))
    wanted = b.state(t).where("delete_status = 2").select("working_email", F.lit(True).alias("override"))
    runs.override(store, wanted)
    return store.read("state").select("username", "delete_status", "override")


# --- Typing -------------------------------------------------------------------------------------------------------


def _event_text():
    return F.when(F.col("event_type") == "error", "n/a").when(F.col("event_type") == "view", "").otherwise(text("value"))


@query
def lenient_typing(t):
    """Numbers in text, with blanks and unreadable ones."""
    return t.events.select("event_id", ty.lenient_number(_event_text()).alias("number"))


@query
def lenient_timestamps(t):
    """ISO and month-first dates, unreadable and blank text."""
    as_text = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "M/d/yyyy"))
        .when(F.col("o_orderpriority") == "5-LOW", "")
        .otherwise(F.concat(F.lit("on "), F.date_format("o_orderdate", "M/d/yyyy")))
    )
    return t.orders.select("o_orderkey", F.date_format(ty.lenient_timestamp(as_text), "yyyy-MM-dd HH:mm:ss").alias("read_as"))


@query
def lenient_flags(t):
    """T4: words as booleans; unknown and blank ones NULL."""
    word = (
        F.when(F.col("l_returnflag") == "A", "Yes")
        .when(F.col("l_returnflag") == "N", "no")
        .when(F.col("l_linestatus") == "O", "unknown")
        .otherwise("")
    )
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", ty.lenient_boolean(word).alias("flag")).agg(F.count(F.lit(1)).alias("n"))


@query
def unreadable_values(t):
    """Rows with a value that cannot be typed, and the column."""
    layout = Layout("events", (Field("Value", "value", "number"), Field("Seen", "seen", "timestamp"), Field("Missing", "missing", "flag")))
    raw = t.events.select("event_id", _event_text().alias("value"), F.when(F.col("event_type") == "click", "yesterday").alias("seen"))
    return dates_as_text(reports.unreadable_rows(raw, layout).select("event_id", "unreadable"))


@query
def blank_test(t):
    """Blank conversation texts and what is left of them."""
    padded = F.when(F.col("role") == "user", F.concat(F.lit("\t "), F.col("text"), F.lit(" \n"))).otherwise(F.regexp_replace("text", r"\S", " "))
    return t.conversations.select(
        "conv_id", "turn", tx.is_blank(padded).alias("blank"), tx.strip(tx.blank_to_null(padded)).alias("stripped")
    )


@query
def long_values(t):
    """Count of texts above the declared width."""
    return t.documents.select("doc_id", ty.too_long(t.documents.select("text", "lang", "source")).alias("too_long"))


# --- History ------------------------------------------------------------------------------------------------------


@query
def history_latest_state(t):
    """Newest event per user and type."""
    newest = latest.latest_per_key(t.events, ["user_id", "event_type"], ["ts", "event_id"], ["value", "props"])
    return newest.select("user_id", "event_type", "event_id", "value", "props", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@query
def history_latest_text(t):
    """Newest copy of each whole text."""
    return latest.latest_per_key(t.documents, ["lang", "text"], ["doc_id"]).select("lang", "text", "doc_id")


@query
def history_caseless(t):
    """§1.5: states that differ in case or trailing blanks are one."""
    varied = t.orders.select(
        text("o_custkey").alias("user"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lower("o_orderpriority"), F.lit("  "))).otherwise(F.col("o_orderpriority")).alias("role"),
        "o_orderkey",
    )
    return latest.latest_per_key(varied, ["user", "role"], ["o_orderkey"], match="caseless")


@query
def history_append_by_name(t):
    """Suppliers into the customers' history by column name."""
    known = t.customer.select(text("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    arrived = t.supplier.select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return history.append_by_name(known, arrived)


def _shown(df: DataFrame, columns: list[str]) -> DataFrame:
    return dates_as_text(df.select(*columns))


ITEM_SHOWN = ["title", "item_id", "item_type", "owner", "share_level", "feature_storage_size", "is_hosted_service", "updated_date"]
MEMBER_SHOWN = ["username", "role", "login_type", "updated_date"]
IDENTITY_SHOWN = ["username", "manager_email", "entra_status", "updated_date"]


@query
def history_items(t):
    """H3, H6: two pending snapshots folded into an item history at once."""
    rows = b.item_rows(t)
    flags = [F.coalesce(F.col("item_type") == flag, F.lit(False)) for flag in ("A", "N")]
    parts = [rows.where(part) for part in (*flags, ~flags[0] & ~flags[1])]
    return _shown(history.fold(parts[0], parts[1:], ITEMS), ITEM_SHOWN)


@query
def history_members(t):
    """H4: distinct member states."""
    return _shown(history.latest_states(b.member_rows(t), MEMBERS), MEMBER_SHOWN)


@query
def history_bootstrap(t):
    """H2, H5: a history begun from its first snapshot, without duplicates."""
    return _shown(history.fold(None, [b.identity_rows(t)], IDENTITY), IDENTITY_SHOWN)


@query
def history_incremental(t):
    """H6, U4: a history folded step by step over the store, pending snapshots found by their dates."""
    store = Store(t.spark, paths.scratch(t.spark, "history"))
    rows = b.identity_rows(t)
    config = runs.RunConfig(RUN_DATE, SUFFIX, DOMAIN, QUOTA)
    early = F.coalesce(F.col("updated_date") < F.lit("1997-01-01").cast("date"), F.lit(False))
    for part, date in ((early, "1996-12-31"), (~early, "2001-07-31")):
        store.write_snapshot("identity", runs.dt.date.fromisoformat(date), rows.where(part))
        runs.fold_history(store, config, "identity")
    return _shown(store.history("identity"), IDENTITY_SHOWN)


@query
def history_compacted(t):
    """H6: the same, with all parts summed up as one in between; states come back after that."""
    store = Store(t.spark, paths.scratch(t.spark, "history"))
    rows = b.identity_rows(t)
    config = runs.RunConfig(RUN_DATE, SUFFIX, DOMAIN, QUOTA)
    early = F.coalesce(F.col("updated_date") < F.lit("1997-01-01").cast("date"), F.lit(False))
    for part, date in ((~early, "2001-07-30"), (early, "2001-07-31")):
        store.write_snapshot("identity", runs.dt.date.fromisoformat(date), rows.where(part))
        runs.fold_history(store, config, "identity")
        store.compact_history("identity", whole=True)
    return _shown(store.history("identity"), IDENTITY_SHOWN)


def _year(rows: DataFrame, year: int) -> DataFrame:
    """Rows of a year, the first and the last one with those before and after; in between one customer in eight comes back."""
    dated = F.least(F.greatest(F.coalesce(F.year("updated_date"), F.lit(0)), F.lit(1995)), F.lit(2001))
    return rows.where((dated == year) | (dated < year) & (F.col("username").cast("int") % 8 == year % 8))


def _folded_by_year(t, each) -> Store:
    """A snapshot for each year of orders folded, with ``each`` done after every fold."""
    store = Store(t.spark, paths.scratch(t.spark, "tiers"))
    rows = b.identity_rows(t)
    config = runs.RunConfig(RUN_DATE + runs.dt.timedelta(days=365), SUFFIX, DOMAIN, QUOTA)
    for year in range(1995, 2002):
        store.write_snapshot("identity", runs.dt.date(year, 12, 31), _year(rows, year))
        runs.fold_history(store, config, "identity")
        each(store)
    return store


@query
def history_tiers(t):
    """H6: seven folds, parts summed up tier by tier; states come back years later."""
    store = _folded_by_year(t, lambda store: store.compact_history("identity"))
    return _shown(store.history("identity"), IDENTITY_SHOWN)


@query
def history_expired(t):
    """What was folded, summed up or replaced is dropped; history, newest snapshot and state stay as they are."""

    def each(store: Store) -> None:
        state = store.read("seen") if store.has("seen") else t.customer.select(text("c_custkey").alias("username"), F.lit(0).alias("n"))
        here = store.snapshot("identity").select("username").distinct().withColumn("here", F.lit(1))
        store.replace("seen", state.join(here, "username", "left").select("username", (F.col("n") + F.coalesce("here", F.lit(0))).alias("n")))
        store.compact_history("identity")
        store.expire(runs.dt.datetime(9999, 1, 1, tzinfo=runs.dt.timezone.utc))

    store = _folded_by_year(t, each)
    parts = {
        "history": store.history("identity").select("username", F.concat_ws(" ", "manager_email", "entra_status", "updated_date")),
        "snapshot": store.snapshot("identity").groupBy("username").agg(F.count(F.lit(1)).cast("string")),
        "state": store.read("seen").select("username", F.col("n").cast("string")),
    }
    named = [df.toDF("username", "value").select(F.lit(part).alias("part"), "username", "value") for part, df in parts.items()]
    return reduce(DataFrame.unionAll, named)


@query
def streaming_intake(t):
    """§2.12: snapshots folded by a stream of their records, each once."""
    store = Store(t.spark, paths.scratch(t.spark, "stream"))
    rows = b.identity_rows(t)
    config = runs.RunConfig(RUN_DATE, SUFFIX, DOMAIN, QUOTA)
    marks = paths.scratch(t.spark, "marks")
    early = F.coalesce(F.col("updated_date") < F.lit("1997-01-01").cast("date"), F.lit(False))
    for part, date in ((early, "1996-12-31"), (~early, "2001-07-31")):
        store.write_snapshot("identity", runs.dt.date.fromisoformat(date), rows.where(part))
        intake.fold_new_snapshots(store, config, "identity", marks).awaitTermination()
    return _shown(store.history("identity"), IDENTITY_SHOWN)


@query
def streaming_rewritten(t):
    """§2.12: a date that is written again between two folds counts by its last writing."""
    store = Store(t.spark, paths.scratch(t.spark, "stream"))
    rows = b.identity_rows(t)
    marks = paths.scratch(t.spark, "marks")
    first = rows.withColumn("manager_email", F.concat(F.lit("first "), F.col("manager_email")))
    for part, run_date in ((first, RUN_DATE), (rows, RUN_DATE + runs.dt.timedelta(days=1))):
        store.write_snapshot("identity", RUN_DATE, part)
        config = runs.RunConfig(run_date, SUFFIX, DOMAIN, QUOTA)
        intake.fold_new_snapshots(store, config, "identity", marks).awaitTermination()
    return _shown(store.history("identity"), IDENTITY_SHOWN)


# --- Lifecycle ----------------------------------------------------------------------------------------------------


@query
def users_without_items(t):
    """Customers without events, or with an event that has no id."""
    return lifecycle.users_without_items(b.members(t), b.event_items(t))


@query
def users_without_items_caseless(t):
    """J2 under a case-insensitive comparison: suppliers by name."""
    people = t.supplier.select(F.upper("s_name").alias("username"))
    things = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    full = (F.col("l_quantity") >= 50) & (F.col("l_discount") == 0)
    owned = things.select(text("l_orderkey").alias("item_id"), F.when(full, F.concat("s_name", F.lit(" "))).alias("owner"))
    return lifecycle.users_without_items(people, owned, match="caseless")


@query
def new_users(t):
    """Customers that are no supplier yet, as new accounts."""
    known = t.supplier.select(text("s_suppkey").alias("username"))
    return dates_as_text(lifecycle.new_accounts(_as_identity(t), known, RUN_DATE))


def _as_identity(t) -> DataFrame:
    return b.members(t).select("username", "name", F.col("email").alias("working_email"), F.lit(None).cast("string").alias("manager_email"))


def _supplier_state(t) -> DataFrame:
    return t.supplier.select(
        text("s_suppkey").alias("username"),
        F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("working_email"),
        F.lit(None).cast("string").alias("manager_email"),
        (F.col("s_nationkey") % 3).cast("int").alias("delete_status"),
        F.lit(None).cast("date").alias("flag_date"),
        F.lit(None).cast("date").alias("delete_date"),
        (F.col("s_acctbal") < 0).alias("override"),
        F.lit(RUN_DATE).alias("updated_date"),
    )


@query
def new_users_upsert(t):
    """Suppliers as the state, customers added."""
    return dates_as_text(lifecycle.add_new_accounts(_supplier_state(t), _as_identity(t), RUN_DATE))


@query
def listed_marker(t):
    """Customers marked by whether they have events."""
    users = t.events.select(text("user_id").alias("id"))
    return mark_listed(b.members(t), F.col("username"), F.col("id"), users, "listed", F.col("username")).select("username", "listed")


@query
def whitelist_match(t):
    """J6 by text: parts whose name has a listed word."""
    people = t.part.select(
        text("p_partkey").alias("username"),
        F.lit(True).alias("entra_status"),
        F.replace("p_name", F.lit(" "), F.lit(" , ")).alias("groups"),
        F.lit(RUN_DATE).alias("updated_date"),
    )
    listed = t.part.select(F.explode(F.split("p_name", " ")).alias("id")).where(F.col("id").isin("red", "ring"))
    facts = lifecycle.account_facts(people, people.select("username").where("username is null"), listed)
    return facts.select(F.substring("_user", 2, 20).alias("username"), "whitelisted")


@query
def whitelist_match_edges(t):
    """J6, S13 by membership: customers in a nation of one region."""
    people = b.members(t).select("username", F.lit(True).alias("entra_status"), F.col("username").alias("directory_id"), F.lit(RUN_DATE).alias("updated_date"))
    edges = t.customer.select(text("c_custkey").alias("user_id"), text("c_nationkey").alias("group_id"))
    listed = t.nation.join(t.region.where("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey")).select(text("n_nationkey").alias("id"))
    facts = lifecycle.account_facts(people, people.select("username").where("username is null"), listed, edges)
    return facts.select(F.substring("_user", 2, 20).alias("username"), "whitelisted")


@query
def account_facts(t):
    """Newest identity row, empty users and whitelist per user."""
    facts = lifecycle.account_facts(
        b.state_identity(t), lifecycle.users_without_items(b.members(t), b.urgent_items(t)), b.segment_whitelist(t)
    )
    return facts.select(F.substring("_user", 2, 20).alias("username"), "entra_status", "empty", "whitelisted")


def _moved(t) -> DataFrame:
    empty = lifecycle.users_without_items(b.members(t), b.urgent_items(t))
    facts = lifecycle.account_facts(b.state_identity(t), empty, b.segment_whitelist(t))
    return lifecycle.transition(b.state(t), facts, RUN_DATE)


@query
def lifecycle_transition(t):
    """L1, J4, J5, J6, P11."""
    return dates_as_text(_moved(t).select("username", "old_status", "rule", "delete_status", "flag_date", "delete_date", "override"))


@query
def lifecycle_counts(t):
    """A4."""
    return lifecycle.rule_counts(_moved(t))


@query
def legacy_counters(t):
    """A5."""
    return lifecycle.legacy_counters(_moved(t))


@query
def delete_list(t):
    """L2: P3, A3, U3, O2."""
    return lifecycle.delete_list(_moved(t))


@query
def delete_counts(t):
    """Accounts in status 2."""
    return lifecycle.in_status(_moved(t), lifecycle.TO_DELETE).agg(F.count(F.lit(1)).alias("accounts"))


@query
def flagged_accounts(t):
    """Accounts in status 1."""
    return dates_as_text(lifecycle.in_status(b.state(t), lifecycle.FLAGGED).select("username", "flag_date"))


@query
def lookup_by_address(t):
    """Accounts of one working address."""
    return lifecycle.by_working_email(b.state(t).withColumn("working_email", F.trim("working_email")), f"c42@{DOMAIN}").select(
        "username", "working_email", "override"
    )


@query
def override_update(t):
    """L3: overrides asked for by address, suppliers giving the requests."""
    asked = t.supplier.select(
        F.concat(F.lit(" c"), text("s_suppkey"), F.lit("@" + DOMAIN)).alias("working_email"), (F.col("s_nationkey") < 5).alias("override")
    )
    return lifecycle.apply_overrides(b.state(t), asked).select("username", "override")


# --- Identity -----------------------------------------------------------------------------------------------------


@query
def candidate_addresses(t):
    """I1, I2."""
    tried = addresses.with_candidates(b.accounts(t), SUFFIX, DOMAIN)
    return tried.select("username", F.concat_ws("|", *addresses.CANDIDATES).alias("candidates"))


@query
def principal_index(t):
    """I5, A6."""
    return identity.principal_index(b.directory(t))


@query
def other_mail_index(t):
    """I6."""
    return identity.other_mail_index(b.directory(t))


@query
def alternate_addresses(t):
    """I3, J9."""
    people = b.directory(t)
    return identity.alternate_index(people, identity.principal_index(people)).select("key", "address", "user_id")


@query
def address_resolution(t):
    """I4, J8."""
    tried = addresses.with_candidates(b.accounts(t), SUFFIX, DOMAIN)
    return identity.resolve(tried, b.directory(t), addresses.CANDIDATES).select("username", "address", "user_id", "alternate")


@query
def manager_lookup(t):
    """J10, I10."""
    return identity.managers(b.manager_edges(t), b.directory(t))


@query
def group_concat_truncated(t):
    """Part keys of an order in line order, cut to 30 characters."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"))
    return identity.joined_in_order(lines, "l_orderkey", "part", ["l_linenumber"], 30)


@query
def group_concat(t):
    """Part keys of an order in line order, all of them."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"))
    return identity.joined_in_order(lines, "l_orderkey", "part", ["l_linenumber"])


def _status(t, legacy_truncate: bool) -> DataFrame:
    """Every part of a supplier is a group of the first customers too, so that some texts are long."""
    return identity.identity_status(
        b.accounts(t), b.directory(t), b.manager_edges(t), b.many_groups(t), RUN_DATE, SUFFIX, DOMAIN, legacy_truncate
    )


@query
def identity_resolution(t):
    """The whole status table, with users of very many groups."""
    return dates_as_text(_status(t, False))


@query
def identity_later_listing(t):
    """Accounts resolved by a listing, then by a later one: only those a difference touches are resolved anew.

    The first listing lacks some users, has other departments and fewer memberships, and some accounts had another e-mail.
    """
    store = Store(t.spark, paths.scratch(t.spark, "listings"))
    key = F.col("id").cast("long")
    people = b.directory(t)
    older = people.where(key % 10 != 3).withColumn("department", F.when(key % 10 == 7, F.lit("OLD")).otherwise(F.col("department")))
    none = t.orders.select(text("o_orderkey").alias("id")).where("id is null")
    listings = {
        RUN_DATE - runs.dt.timedelta(days=30): (older, b.many_groups(t).where(F.col("pos") % 50 != 7)),
        RUN_DATE: (people, b.many_groups(t)),
    }
    for date, (users, groups) in listings.items():
        accounts = b.accounts(t).withColumn("email", F.when((F.length("name") % 2 == 0) | (date == RUN_DATE), F.col("email")).otherwise(F.lit("x@y")))
        store.write_snapshot("members", date, b.in_layout(accounts, MEMBERS))
        runs.resolve_members(store, runs.RunConfig(date, SUFFIX, DOMAIN, QUOTA, group_digest=False), runs.Directory(users, b.manager_edges(t), groups, none))
    return dates_as_text(store.snapshot("identity", RUN_DATE))


@query
def identity_resolution_legacy(t):
    """The same with texts cut to the former lengths."""
    return dates_as_text(_status(t, True))


@query
def history_late_group(t):
    """H5: only the last of very many groups changes; that is a state of its own.

    The state has the digest of the groups, and the memberships of each date are rows; their text is made for the result.
    """
    edges = b.many_groups(t)
    last = edges.groupBy("user_id").agg(F.max("pos").alias("_last"))
    marked = edges.join(last, "user_id").withColumn("late", F.col("pos") == F.col("_last"))
    parts = {"2001-07-01": marked.where("not late"), "2001-08-01": marked}
    rows, texts = [], []
    for day, part in parts.items():
        date = F.lit(day).cast("date").alias("updated_date")
        groups = identity.group_digest(part)
        rows.append(b.in_layout(groups.select(F.col("user_id").alias("username"), "groups", date), IDENTITY))
        texts.append(identity.group_text(part).select(F.col("user_id").alias("username"), "groups", date))
    states = history.fold(rows[0], rows[1:], IDENTITY).select("username", "updated_date")
    return dates_as_text(states.join(reduce(DataFrame.unionAll, texts), ["username", "updated_date"]).select("username", "groups", "updated_date"))


@query
def identity_errors(t):
    """Accounts without a user name among resolved rows."""
    status = identity.identity_status(
        b.accounts(t).withColumn("username", F.when(F.col("email").isNotNull(), F.col("username")).otherwise(F.lit(" "))),
        b.directory(t), b.manager_edges(t), b.group_edges(t), RUN_DATE, SUFFIX, DOMAIN,
    )
    return identity.error_rows(status).select("name")


# --- Notifications ------------------------------------------------------------------------------------------------


@query
def contacts_ordered_distinct(t):
    """Priorities of a customer by first order."""
    rows = t.orders.select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    listed = contacts.ordered_distinct(rows, "o_custkey", "o_orderpriority", ["o_orderdate", "o_orderkey"], "priorities")
    return dates_as_text(listed)


@query
def contacts_of_accounts(t):
    """Accounts with every manager address of their history; customers and suppliers, some without any."""
    people = b.state(t).select("username", "name").union(t.supplier.select(F.col("s_name"), F.col("s_name")))
    return dates_as_text(notify.recipients(people, b.identity_rows(t)).select("username", "name", "manager_emails"))


def _queue(t) -> DataFrame:
    report = quota.over_quota(b.members(t), b.order_items(t), QUOTA)
    return notify.notification_queue(_moved(t), b.identity_rows(t), report, DEFAULT_TEMPLATES, QUOTA)


@query
def notification_queue(t):
    """The whole queue."""
    return dates_as_text(_queue(t))


@query
def contacts_maintained(t):
    """Manager addresses by first appearance, from a table that each of seven folds brought up to date."""
    store = _folded_by_year(t, lambda store: None)
    return dates_as_text(contacts.ordered_distinct(store.read(runs.CONTACTS), "username", "manager_email", ["updated_date"], "manager_emails"))


@query
def quota_notices(t):
    """N4, N6."""
    report = quota.over_quota(b.members(t), b.order_items(t), QUOTA)
    return notify.quota_notices(report, DEFAULT_TEMPLATES, QUOTA).select("username", "recipient", "subject", "body")


@query
def notification_preview(t):
    """N7, N8."""
    return notify.preview(_queue(t))


@query
def notification_counts(t):
    """A4: messages and skipped ones by kind."""
    return notify.queue_counts(_queue(t))


@query
def template_fill(t):
    """A template filled per customer; a name with a place in it is not filled again."""
    name = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("{balance}")).when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name"))
    body = templates.fill("Dear {name},\nbalance {balance} of {{all}}", {"name": name, "balance": templates.two_decimals(F.col("c_acctbal"))})
    return t.customer.select("c_custkey", body.alias("body"))


# --- Whole run ----------------------------------------------------------------------------------------------------


def _deliver(t, root: str, date: str, share) -> str:
    """Reports of a date: all accounts; orders as items, of which only a ``share`` has an owner."""
    folder = f"{root}/incoming-{date}"
    people = b.in_layout(b.accounts(t), MEMBERS)
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").select(
        text("o_orderkey").alias("item_id"),
        F.when(share, F.concat("c_name", F.lit("_ORG"))).alias("owner"),
        F.col("o_totalprice").alias("feature_storage_size"),
        F.col("o_orderdate").alias("date_created"),
    )
    reports.write_csv(people.drop("updated_date"), f"{folder}/OrganizationMembers_{date}", MEMBERS)
    reports.write_csv(b.in_layout(owned, ITEMS).drop("updated_date"), f"{folder}/OrganizationItems_{date}", ITEMS)
    return folder


def _first_run(t, exports: runs.Directory) -> Store:
    store = Store(t.spark, paths.scratch(t.spark, "run"))
    folder = _deliver(t, store.root, "2001-08-01", F.lit(True))
    runs.full_run(t.spark, store.root, runs.RunConfig(RUN_DATE, SUFFIX, DOMAIN, QUOTA), folder, exports)
    return store


@query
def whole_run(t):
    """All steps from CSV reports to the new state, accounts resolved to the directory as exported in files."""
    store = _first_run(t, _read_directory(t))
    return dates_as_text(store.read("moves").select("username", "working_email", "rule", "delete_status", "flag_date"))


@query
def run_counts(t):
    """A4: everything a run counted, taken in the jobs that wrote its tables."""
    return counts.run_counts(_first_run(t, _read_directory(t))).select("step", "name", "value")


@query
def second_run(t):
    """A second run 35 days later over the first one's store: overrides, aging, history, reports and notifications.

    Meanwhile some flagged accounts were put under override, and half of the items lost their owner. The result is what
    each step left behind, read back.
    """
    exports = _read_directory(t)
    store = _first_run(t, exports)
    asked = store.read("state").where("delete_status = 1 and username like '%7_ORG'")
    runs.override(store, asked.select("working_email", F.lit(True).alias("override")))
    later = runs.RunConfig(RUN_DATE + runs.dt.timedelta(days=35), SUFFIX, DOMAIN, QUOTA)
    folder = _deliver(t, store.root, "2001-09-05", F.col("c_custkey") % 2 == 0)
    runs.full_run(t.spark, store.root, later, folder, exports)
    queue = runs.queue_notifications(store, later)
    gone = reports.read_text_columns(t.spark, reports.newest_dated_path(t.spark, f"{store.root}/reports", "UsersToDelete"))
    parts = {
        "move": store.read("moves").select("username", F.concat_ws(" ", "rule", "old_status", "delete_status", F.col("flag_date").cast("string"))),
        "delete": gone.select(F.col(gone.columns[0]).alias("username"), F.lit(None).cast("string").alias("value")),
        "quota": runs.read_over_quota(store).select("username", F.col("total_feature_storage_mb").cast("decimal(28,2)").cast("string")),
        "notice": queue.select("username", F.concat_ws(" ", "kind", F.coalesce("recipient", "skip_reason"))),
        "history": store.history("items").where("owner is not null").groupBy("owner").agg(F.count(F.lit(1)).cast("string")),
    }
    named = [df.toDF("username", "value").select(F.lit(part).alias("part"), "username", "value") for part, df in parts.items()]
    return reduce(DataFrame.unionAll, named)
