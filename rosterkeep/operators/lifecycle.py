"""Account states: 0 in use, 1 flagged, 2 to be deleted."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rosterkeep.functions.text import caseless, is_blank, strip
from rosterkeep.model import STATE
from rosterkeep.operators.keys import mark_listed, missing_from, null_safe_key, same_key

ACTIVE, FLAGGED, TO_DELETE = 0, 1, 2


# --- Who owns nothing ---------------------------------------------------------------------------------------------


def users_without_items(members: DataFrame, items: DataFrame, match: str = "binary") -> DataFrame:
    """Distinct user names without an item, or with an item that has no id.

    One aggregate per owner decides both; members are anti-joined to the owners whose items all have an id. Both sides
    are reduced before their shuffle, so neither a busy owner nor repeated or NULL user names pile up.
    """
    fold_case = caseless if match == "caseless" else (lambda c: c)
    owners = (
        items.where("owner is not null")
        .groupBy(fold_case(F.col("owner")).alias("_owner"))
        .agg(F.bool_and(F.col("item_id").isNotNull()).alias("_all_known"))
        .where("_all_known")
    )
    names = members.select("username").distinct()
    return names.join(owners, fold_case(F.col("username")) == F.col("_owner"), "left_anti")


# --- New accounts -------------------------------------------------------------------------------------------------


def new_accounts(identity: DataFrame, state: DataFrame, run_date: dt.date) -> DataFrame:
    """State rows for the identity rows whose user is not in the state yet."""
    fresh = missing_from(identity.select("username", "name", "working_email", "manager_email"), state, "username")
    return fresh.select(
        "username",
        "name",
        "working_email",
        "manager_email",
        F.lit(ACTIVE).alias("delete_status"),
        F.lit(None).cast("date").alias("flag_date"),
        F.lit(None).cast("date").alias("delete_date"),
        F.lit(False).alias("override"),
        F.lit(run_date).cast("date").alias("updated_date"),
    )


def add_new_accounts(state: DataFrame, identity: DataFrame, run_date: dt.date) -> DataFrame:
    """The state with new users added as active; known rows stay untouched."""
    return state.select(*STATE.columns).unionByName(new_accounts(identity, state, run_date))


# --- Facts about an account ---------------------------------------------------------------------------------------


def account_facts(
    identity: DataFrame,
    empty_users: DataFrame,
    whitelist: DataFrame,
    group_edges: DataFrame | None = None,
) -> DataFrame:
    """One row per user: ``entra_status`` (NULL if unknown), ``empty``, ``whitelisted``.

    Users are keyed by ``_user``, a NULL-safe key. Of several identity rows the newest counts. With ``group_edges``
    the whitelist is compared with all groups of the directory user (``identity.directory_id``); without them with the
    groups text, which may have been cut.
    """
    from_edges = group_edges is not None
    payload = ["updated_date", "entra_status", "directory_id" if from_edges else "groups"]
    known = identity.where("username is not null").select(
        null_safe_key(F.col("username")).alias("_user"),
        F.struct(*payload).alias("_row"),
        F.lit(False).alias("empty"),
    )
    none = F.lit(None).cast(known.schema["_row"].dataType)
    empties = empty_users.select(
        null_safe_key(F.col("username")).alias("_user"), none.alias("_row"), F.lit(True).alias("empty")
    )
    facts = (
        known.unionByName(empties)
        .groupBy("_user")
        .agg(F.max("_row").alias("_row"), F.max("empty").alias("empty"))
        .select("_user", "empty", "_row.*")
    )
    if from_edges:
        hits = whitelisted_directory_users(group_edges, whitelist)
        return mark_listed(
            facts, F.when(F.col("entra_status"), F.col("directory_id")), F.col("user_id"), hits, "whitelisted", F.col("_user")
        ).select("_user", "entra_status", "empty", "whitelisted")
    # Only the groups of affiliated users can matter, so only theirs are spread out.
    groups = F.when(F.col("entra_status"), F.split("groups", ","))
    parts = facts.select("_user", "entra_status", "empty", F.explode_outer(groups).alias("_part"))
    spread = parts.withColumn("_group", F.when(~is_blank(F.col("_part")), strip(F.col("_part"))))
    marked = mark_listed(spread, F.col("_group"), F.col("id"), whitelist, "whitelisted", F.col("_user"))
    return marked.groupBy("_user").agg(
        F.max("entra_status").alias("entra_status"),
        F.max("empty").alias("empty"),
        F.max("whitelisted").alias("whitelisted"),
    )


def whitelisted_directory_users(group_edges: DataFrame, whitelist: DataFrame) -> DataFrame:
    """Directory users in at least one whitelisted group."""
    ids = whitelist.select(F.col("id").alias("_listed")).distinct()
    return group_edges.join(ids, same_key(F.col("group_id"), F.col("_listed")), "left_semi").select("user_id").distinct()


# --- Transition ---------------------------------------------------------------------------------------------------


def decide(
    status: Column,
    flag_date: Column,
    override: Column,
    empty: Column,
    entra_status: Column,
    whitelisted: Column,
    run_date: dt.date,
    grace_days: int,
) -> Column:
    """Name of the rule that applies to an account, the first that fits."""
    age = F.datediff(F.lit(run_date), flag_date)
    return (
        F.when(override, "R1")
        .when(empty, "R2")
        .when((status == ACTIVE) & ~entra_status, "R3")
        .when((status == ACTIVE) & entra_status & whitelisted, "R4")
        .when((status == ACTIVE) & entra_status, "R5")
        .when(status == ACTIVE, "R6")
        .when((status == FLAGGED) & (age >= grace_days), "R7")
        .otherwise("R8")
    )


#: What a rule sets: new status, flag date, delete date. "run" is the run date, "none" is NULL, "keep" leaves it.
EFFECTS = {
    "R1": (ACTIVE, "none", "none"),
    "R2": (TO_DELETE, "run", "keep"),
    "R3": (FLAGGED, "run", "keep"),
    "R4": (ACTIVE, "none", "none"),
    "R5": (FLAGGED, "run", "keep"),
    "R6": ("keep", "keep", "keep"),
    "R7": (TO_DELETE, "keep", "run"),
    "R8": ("keep", "keep", "keep"),
}


def _effect(position: int, current: Column, run_date: dt.date) -> Column:
    rule, result = F.col("rule"), None
    for name, effects in EFFECTS.items():
        effect = effects[position]
        if effect == "keep":
            continue
        value = {"run": F.lit(run_date).cast("date"), "none": F.lit(None).cast("date")}.get(effect, F.lit(effect))
        result = F.when(rule == name, value) if result is None else result.when(rule == name, value)
    return result.otherwise(current)


def transition(
    state: DataFrame, facts: DataFrame, run_date: dt.date, grace_days: int = 30, keep: Sequence[str] = ()
) -> DataFrame:
    """The state after one run, each row with its ``old_status`` and the ``rule`` applied (L1).

    One left join to the facts and one projection; rows are neither lost nor added. ``keep`` names facts to be kept.
    """
    joined = state.withColumn("_key", null_safe_key(F.col("username"))).join(
        facts, same_key(F.col("_key"), F.col("_user")), "left"
    )
    decided = joined.withColumn(
        "rule",
        decide(
            F.col("delete_status"),
            F.to_date("flag_date"),
            F.coalesce(F.col("override"), F.lit(False)),
            F.coalesce(F.col("empty"), F.lit(False)),
            F.col("entra_status"),
            F.coalesce(F.col("whitelisted"), F.lit(False)),
            run_date,
            grace_days,
        ),
    )
    changed = {
        "delete_status": _effect(0, F.col("delete_status"), run_date).cast("int"),
        "flag_date": _effect(1, F.to_date("flag_date"), run_date),
        "delete_date": _effect(2, F.to_date("delete_date"), run_date),
    }
    return decided.select(
        *[changed.get(name, F.col(name)).alias(name) for name in state.columns],
        F.col("delete_status").alias("old_status"),
        "rule",
        *keep,
    )


def rule_counts(moved: DataFrame) -> DataFrame:
    """Accounts by rule and new status (A4)."""
    return moved.groupBy("rule", F.col("delete_status").alias("new_status")).agg(F.count(F.lit(1)).alias("accounts"))


#: Class under which the older run report counted a rule; for R8 it went by the status.
LEGACY_CLASS = {
    "R1": "unflagged",
    "R2": "flagged",
    "R3": "unflagged",
    "R4": "unflagged",
    "R5": "flagged",
    "R7": "deleted",
}


def legacy_counters(moved: DataFrame) -> DataFrame:
    """One row with the counters ``unflagged``, ``flagged``, ``deleted`` as the older run report gave them (A5)."""
    by_rule = F.coalesce(*[F.when(F.col("rule") == rule, F.lit(name)) for rule, name in LEGACY_CLASS.items()])
    left_over = F.when(F.col("rule") == "R8", F.when(F.col("old_status") == FLAGGED, "flagged").when(F.col("old_status") == TO_DELETE, "deleted"))
    counted = moved.select(F.coalesce(by_rule, left_over).alias("_class"))
    return counted.agg(*[F.count_if(F.col("_class") == name).alias(name) for name in ("unflagged", "flagged", "deleted")])


# --- Lists and changes by hand ------------------------------------------------------------------------------------


def in_status(state: DataFrame, status: int) -> DataFrame:
    """Accounts in a status."""
    return state.where(F.col("delete_status") == status)


def delete_list(state: DataFrame) -> DataFrame:
    """Distinct user names to delete, sorted (L2: P3, A3, U3, O2)."""
    return in_status(state, TO_DELETE).select("username").distinct().orderBy("username")


def by_working_email(state: DataFrame, address: str) -> DataFrame:
    """State rows of a working address."""
    return state.where(F.col("working_email") == address)


def apply_overrides(state: DataFrame, requests: DataFrame) -> DataFrame:
    """State with the override set as requested per working address; other rows keep theirs (L3).

    Of conflicting requests for one address the one that protects the account wins. Rows without an address are set
    aside from the join: they match nothing and would all meet in one task.
    """
    wanted = (
        requests.where("working_email is not null")
        .groupBy(F.col("working_email").alias("_address"))
        .agg(F.max("override").alias("_override"))
    )
    addressed, rest = state.where("working_email is not null"), state.where("working_email is null")
    changed = addressed.join(wanted, same_key(F.col("working_email"), F.col("_address")), "left").withColumn(
        "override", F.coalesce("_override", "override")
    )
    return changed.select(*state.columns).unionByName(rest)
