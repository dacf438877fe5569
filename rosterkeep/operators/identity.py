"""Accounts to directory users, by an ordered list of candidate addresses.

The tables used: ``directory`` (id, user_principal_name, mail, other_mails, department, listing_pos),
``manager_edges`` (user_id, manager_id), ``group_edges`` (user_id, group_id, pos).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from rosterkeep.functions.addresses import CANDIDATES, with_candidates
from rosterkeep.functions.text import blank_to_null, cut, is_blank, lookup_key, strip
from rosterkeep.model import IDENTITY
from rosterkeep.operators.keys import same_key
from rosterkeep.operators.latest import first_per_key

#: Lengths texts were cut to before; only on request.
LEGACY_TRIED, LEGACY_GROUPS = 500, 1000


# --- Indexes over the directory -----------------------------------------------------------------------------------


def principal_index(directory: DataFrame) -> DataFrame:
    """``key, user_id, department``: users by principal name and by mail, the first in the listing winning."""
    addresses = directory.select(
        F.explode(F.array(lookup_key(F.col("user_principal_name")), lookup_key(F.col("mail")))).alias("key"),
        "listing_pos",
        F.col("id").alias("user_id"),
        "department",
    ).where("key != ''")
    return first_per_key(addresses, ["key"], ["listing_pos"], ["user_id", "department"]).drop("listing_pos")


def other_mail_index(directory: DataFrame) -> DataFrame:
    """``key, principal_name``: principal name by other mail; the first user wins, even one without a name."""
    addresses = directory.select(
        F.explode("other_mails").alias("_mail"),
        "listing_pos",
        F.col("id").alias("user_id"),
        F.col("user_principal_name").alias("principal_name"),
    ).select(lookup_key(F.col("_mail")).alias("key"), "listing_pos", "user_id", "principal_name")
    first = first_per_key(addresses.where("key != ''"), ["key"], ["listing_pos"], ["user_id", "principal_name"])
    return first.select("key", "principal_name").where("principal_name != ''")


def alternate_index(directory: DataFrame, principals: DataFrame) -> DataFrame:
    """``key, address, user_id, department``: the user an account is led to by an other mail.

    The principal name found is looked up like any address, so the user is the one that name resolves to.
    """
    named = other_mail_index(directory).select(
        F.col("key").alias("_other"), F.col("principal_name").alias("address"), lookup_key(F.col("principal_name")).alias("_name")
    )
    return named.join(principals, same_key(F.col("_name"), F.col("key")), "left").select(
        F.col("_other").alias("key"), "address", "user_id", "department"
    )


def resolution_index(directory: DataFrame) -> DataFrame:
    """``key, led, address, user_id, department``: both ways from an address to a user, directly or ``led`` by another one."""
    principals = principal_index(directory)
    index = principals.select("key", F.lit(False).alias("led"), F.lit(None).cast("string").alias("address"), "user_id", "department")
    alternates = alternate_index(directory, principals)
    return index.unionByName(alternates.select("key", F.lit(True).alias("led"), "address", "user_id", "department"))


# --- Resolution ---------------------------------------------------------------------------------------------------


def _tries(accounts: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """A narrow row for each address an account tries."""
    listed = F.posexplode(F.array(*candidates)).alias("pos", "tried")
    return accounts.select("username", "email", listed).where("tried is not null").withColumn("_key", lookup_key(F.col("tried")))


def resolve(accounts: DataFrame, directory: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Directory user per distinct (username, email) that leads to one, or to an alternate address."""
    return resolve_by(accounts, resolution_index(directory), candidates)


def resolve_by(accounts: DataFrame, index: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """The same by a ``resolution_index``.

    Result: ``username, email, address, user_id, department, alternate``. ``candidates`` are columns of the accounts, in
    the order they are tried, NULL where there is none. They are spread out as narrow rows and meet one index of both
    ways to a user by equality, so they are shuffled once; an aggregate then keeps the first hit in candidate order. It
    is keyed by the account's own values, not by a generated row number, so a task that is run again cannot give other
    keys. A key that very many accounts try, as the bare ``@domain``, is split by adaptive execution.
    """
    tries = _tries(accounts, candidates)
    hit = F.struct("pos", F.when(F.col("led"), F.col("address")).otherwise(F.col("tried")).alias("address"), "user_id", "department", "tried")
    first = (
        tries.join(index, same_key(F.col("_key"), F.col("key")))
        .groupBy("username", "email")
        .agg(F.min(F.when(~F.col("led"), hit)).alias("_direct"), F.min(F.when(F.col("led"), hit)).alias("_alternate"))
    )
    alternate = F.when(strip(F.col("_alternate.address")) != "", F.col("_alternate"))
    return (
        first.withColumn("_hit", F.coalesce(F.col("_direct"), alternate))
        .select("username", "email", "_hit.address", "_hit.user_id", "_hit.department", alternate["address"].alias("alternate"))
    )


# --- Manager and groups -------------------------------------------------------------------------------------------


def managers(manager_edges: DataFrame, directory: DataFrame) -> DataFrame:
    """``user_id, manager_email, manager_department``; users without a known manager are left out.

    An id listed more than once counts by its last listing. The result is grouped by user last, so it comes out in the
    partitioning the next join needs.
    """
    people = directory.where("id is not null").groupBy(F.col("id").alias("_id")).agg(
        F.max(F.struct("listing_pos", "mail", "department")).alias("_person")
    )
    edges = manager_edges.where("user_id is not null")
    known = edges.join(people, same_key(F.col("manager_id"), F.col("_id"))).select(
        "user_id", F.struct("manager_id", F.col("_person.mail").alias("mail"), F.col("_person.department").alias("department")).alias("_manager")
    )
    first = known.groupBy("user_id").agg(F.min("_manager").alias("_manager"))
    return first.select(
        "user_id", F.col("_manager.mail").alias("manager_email"), F.col("_manager.department").alias("manager_department")
    )


def joined_in_order(edges: DataFrame, key: str, value: str, order: list[str], length: int | None = None) -> DataFrame:
    """``key`` with its values joined by ``", "`` in order (A7, I9, J11), whole or cut to ``length`` characters.

    Where it is cut: each value but the first brings a separator of two characters, so a value that half the length
    and more come before lies behind the cut. Only the others are gathered; Spark applies that rank limit before the
    shuffle too.
    """
    listed = edges.where(F.col(value).isNotNull())
    if length is not None:
        rank = F.row_number().over(Window.partitionBy(key).orderBy(*order, value))
        listed = listed.withColumn("_rank", rank).where(F.col("_rank") <= (length + 1) // 2 + 1)
    # A value is in its entry once; ``sort_array`` compares entries natively, ``array_sort`` by an interpreted function.
    gathered = listed.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order, F.col(value).alias("_value")))).alias("_list"))
    text = F.array_join(F.col("_list._value").cast("array<string>"), ", ")
    return gathered.select(key, (text if length is None else cut(text, length)).alias(f"{value}s"))


def group_text(group_edges: DataFrame, length: int | None = None) -> DataFrame:
    """``user_id, groups``: group ids of a user as text."""
    text = joined_in_order(group_edges.where("user_id is not null"), "user_id", "group_id", ["pos"], length)
    return text.withColumnRenamed("group_ids", "groups")


def group_digest(group_edges: DataFrame) -> DataFrame:
    """``user_id, groups``: number and digest of a user's groups (H5), which is the same however they are dealt out.

    Two sums of hashes of group and position: any change of the text of the groups changes it, but nothing is gathered, and a
    user of very many groups is one row a task in the shuffle.
    """
    listed = group_edges.where("user_id is not null and group_id is not null")
    sums = [F.sum(F.xxhash64(F.lit(k), "pos", "group_id").cast("decimal(20,0)")).cast("string") for k in (1, 2)]
    return listed.groupBy("user_id").agg(F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums).alias("groups"))


def with_group_text(identity: DataFrame, group_edges: DataFrame) -> DataFrame:
    """Rows with the digest of the groups replaced by their text, for a report; nothing else gathers a user's groups."""
    text = group_text(group_edges).select(F.col("user_id").alias("_user"), F.col("groups").alias("_text"))
    joined = identity.join(text, same_key(F.col("directory_id"), F.col("_user")), "left")
    return joined.withColumn("groups", F.when(F.col("groups").isNotNull(), F.col("_text"))).drop("_user", "_text")


# --- The status table ---------------------------------------------------------------------------------------------


def identity_status(
    members: DataFrame,
    directory: DataFrame,
    manager_edges: DataFrame,
    group_edges: DataFrame,
    run_date: dt.date,
    suffix: str,
    domain: str,
    legacy_truncate: bool = False,
) -> DataFrame:
    """One row per member row, found or not (I7, I8). ``directory_id`` is added for comparing all groups later.

    The addresses tried and the groups are whole texts, so that the history sees every change of them;
    ``legacy_truncate`` cuts them to the former lengths. Manager and groups are joined to the accounts that were found
    only; accounts without a directory user never meet under a NULL id.
    """
    profiles = user_profiles(directory, manager_edges, group_edges, legacy_truncate)
    return status_rows(members, resolution_index(directory), profiles, run_date, suffix, domain, legacy_truncate)


def user_profiles(
    directory: DataFrame, manager_edges: DataFrame, group_edges: DataFrame, legacy_truncate: bool = False, digest: bool = False
) -> DataFrame:
    """``user_id, manager_email, manager_department, groups`` of the users that have either; the groups as text or ``digest``.

    Both sides have one row per user and the same partitioning, so the join shuffles nothing.
    """
    groups = group_digest(group_edges) if digest else group_text(group_edges, LEGACY_GROUPS if legacy_truncate else None)
    return managers(manager_edges, directory).join(groups, "user_id", "full")


#: Columns of the status that come from the profile of the directory user.
OF_PROFILE = ("manager_email", "manager_department", "groups")


def status_rows(
    members: DataFrame, index: DataFrame, profiles: DataFrame, run_date: dt.date, suffix: str, domain: str, legacy_truncate: bool = False
) -> DataFrame:
    """``identity_status`` from a ``resolution_index`` and ``user_profiles``."""
    return with_profiles(found_rows(members, index, run_date, suffix, domain, legacy_truncate), profiles)


def found_rows(
    members: DataFrame, index: DataFrame, run_date: dt.date, suffix: str, domain: str, legacy_truncate: bool = False
) -> DataFrame:
    """The status without the columns of the profile."""
    tried = with_candidates(members.select("username", "email", "name"), suffix, domain)
    found = resolve_by(tried, index, CANDIDATES).withColumnsRenamed({"username": "_username", "email": "_email"})
    joined = tried.join(
        found,
        F.col("username").eqNullSafe(F.col("_username")) & F.col("email").eqNullSafe(F.col("_email")),
        "left",
    )
    alternate = F.lower("alternate")
    known = reduce(or_, [F.lower(name).eqNullSafe(alternate) for name in CANDIDATES])
    emails_tried = F.concat_ws(", ", *CANDIDATES, F.when(~known, F.col("alternate")))
    row = {
        "emails_tried": cut(emails_tried, LEGACY_TRIED) if legacy_truncate else emails_tried,
        "entra_status": F.col("address").isNotNull(),
        "user_department": blank_to_null(F.col("department")),
        "working_email": F.col("address"),
        "updated_date": F.lit(run_date).cast("date"),
    }
    columns = [name for name in IDENTITY.columns if name not in OF_PROFILE]
    return joined.select(*[row.get(name, F.col(name)).alias(name) for name in columns], F.col("user_id").alias("directory_id"))


def with_profiles(rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """``found_rows`` with manager and groups of their directory users; further columns stay, last.

    This join comes last, so the text of a user's groups is shuffled once for the user and not with each account that leads
    to them. Accounts without a directory user are spread over the tasks by their names.
    """
    spread = F.coalesce(F.col("directory_id"), F.concat_ws(" ", "username", "email", "name"))
    profile = profiles.select(F.col("user_id").alias("_id"), *[blank_to_null(F.col(name)).alias(name) for name in OF_PROFILE])
    joined = rows.withColumn("_probe", spread).join(
        profile, same_key(F.col("_probe"), F.col("_id")) & F.col("directory_id").isNotNull(), "left"
    )
    further = [name for name in rows.columns if name not in {*IDENTITY.columns, "directory_id"}]
    return joined.select(*IDENTITY.columns, "directory_id", *further)


# --- Only what changed --------------------------------------------------------------------------------------------


def changed_keys(before: DataFrame, now: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose row is new, gone or different: two tables with a row a key, compared by a digest of the rest."""
    rest = [name for name in now.columns if name not in key]

    def digests(df: DataFrame, name: str) -> DataFrame:
        return df.select(*key, F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in rest]).alias(name))

    both = digests(before, "_before").join(digests(now, "_now"), list(key), "full")
    return both.where(~F.col("_before").eqNullSafe(F.col("_now"))).select(*key)


def _account_key() -> Column:
    """Digest of the values an account is known by."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in ("username", "email", "name")]
    return F.sha2(F.concat_ws("\0", *[F.concat(F.length(v).cast("string"), F.lit(":"), v) for v in values]), 256)


def split_affected(
    members: DataFrame, previous: DataFrame, addresses: DataFrame, users: DataFrame, suffix: str, domain: str
) -> tuple[DataFrame, DataFrame]:
    """Member rows that have to be resolved again, and the rows of the ``previous`` status that others keep (I4).

    Leave the columns of the profile out of ``previous`` and add them after (``with_profiles``): rows are shuffled here.

    An account is affected if it is new, if it tries an address (``key``) whose place in the index changed, or if it led to
    a user (``user_id``) whose manager or groups changed. Its other values cannot have changed: the status of an account is
    a function of its own values, the index at its addresses, and its user's profile.
    """
    known = previous.withColumn("_account", _account_key()).dropDuplicates(["_account"])
    people = members.select("username", "email", "name").withColumn("_account", _account_key())
    tries = _tries(with_candidates(people, suffix, domain).drop("_account"), CANDIDATES).select("username", "email", "_key")
    touched = tries.join(addresses.select("key").distinct(), same_key(F.col("_key"), F.col("key")), "left_semi")
    moved = known.join(users.select(F.col("user_id").alias("_user")).distinct(), same_key(F.col("directory_id"), F.col("_user")), "left_semi")
    pairs = touched.select("username", "email").unionByName(moved.select("username", "email")).distinct().withColumn("_affected", F.lit(True))
    pairs = pairs.withColumnsRenamed({"username": "_username", "email": "_email"})
    marked = people.join(
        pairs, F.col("username").eqNullSafe(F.col("_username")) & F.col("email").eqNullSafe(F.col("_email")), "left"
    ).drop("_username", "_email")
    kept = known.select(F.col("_account").alias("_known"), F.struct(*previous.columns).alias("_row"))
    both = marked.join(kept, same_key(F.col("_account"), F.col("_known")), "left")
    stays = F.col("_affected").isNull() & F.col("_known").isNotNull()
    return both.where(~stays).select("username", "email", "name"), both.where(stays).select("_row.*")


def is_error() -> Column:
    """Whether a row cannot be used further: it has no user name, or nothing to try."""
    return is_blank(F.col("username")) | (F.coalesce(F.col("emails_tried"), F.lit("")) == "")


def error_rows(identity: DataFrame) -> DataFrame:
    """User names of rows that cannot be used further: those without a user name or without anything to try."""
    return identity.where(is_error())
