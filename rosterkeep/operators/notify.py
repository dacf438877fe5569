"""The queue of messages to send; nothing is sent."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rosterkeep.functions.templates import fill, two_decimals
from rosterkeep.functions.text import is_blank, join_list, strip
from rosterkeep.operators.contacts import ordered_distinct, with_contacts
from rosterkeep.operators.lifecycle import FLAGGED, TO_DELETE

#: Kind of notice by account status, in sending order; the quota notice comes after these.
STATUS_KINDS = {"delete": TO_DELETE, "flag": FLAGGED}
QUOTA_KIND = "quota"
NO_ADDRESS = "no recipient address"


@dataclass(frozen=True)
class Template:
    subject: str
    body: str


def recipients(state: DataFrame, identity_history: DataFrame) -> DataFrame:
    """State rows with every manager address their user ever had, as ``manager_emails``."""
    contacts = ordered_distinct(identity_history, "username", "manager_email", ["updated_date"], "manager_emails")
    return with_contacts(state, contacts, "username", "manager_emails")


def _queue(df: DataFrame, kind: Column, address: str, cc: Column, texts: Mapping[str, Template], places: dict[str, Column]) -> DataFrame:
    """Queue columns; kind by kind the texts are literals of the plan, so there is no join with the templates."""
    copies = F.filter(cc, lambda a: a != F.lit(""))
    subject = F.coalesce(*[F.when(F.col("kind") == name, F.lit(t.subject)) for name, t in texts.items()])
    body = F.coalesce(*[F.when(F.col("kind") == name, fill(t.body, places)) for name, t in texts.items()])
    return df.withColumn("kind", kind).select(
        "kind",
        "username",
        F.when(~is_blank(F.col(address)), strip(F.col(address))).alias("recipient"),
        copies.alias("cc"),
        F.size(copies).alias("cc_count"),
        subject.alias("subject"),
        body.alias("body"),
        F.when(is_blank(F.col(address)), NO_ADDRESS).alias("skip_reason"),
    )


def status_notices(people: DataFrame, templates: Mapping[str, Template]) -> DataFrame:
    """Delete and flag notices to the working address, managers in copy.

    ``people`` is the state with ``manager_emails``. Both kinds come from one pass over it.
    """
    kind = F.coalesce(*[F.when(F.col("delete_status") == status, F.lit(name)) for name, status in STATUS_KINDS.items()])
    places = {"recipient_name": F.col("name"), "recipient_username": F.col("username")}
    chosen = people.where(F.col("delete_status").isin(*STATUS_KINDS.values()))
    return _queue(chosen, kind, "working_email", F.col("manager_emails"), {k: templates[k] for k in STATUS_KINDS}, places)


def quota_notices(over_quota: DataFrame, templates: Mapping[str, Template], quota_mb: float) -> DataFrame:
    """Quota notices to the reported address, nobody in copy."""
    places = {
        "recipient_name": F.col("name"),
        "recipient_username": F.col("username"),
        "total_feature_storage_mb": two_decimals(F.col("total_feature_storage_mb")),
        "USER_STORAGE_QUOTA_MB": F.lit(f"{quota_mb:.2f}"),
    }
    nobody = F.array().cast("array<string>")
    return _queue(over_quota, F.lit(QUOTA_KIND), "email", nobody, {QUOTA_KIND: templates[QUOTA_KIND]}, places)


def notification_queue(
    state: DataFrame,
    identity_history: DataFrame,
    over_quota: DataFrame,
    templates: Mapping[str, Template],
    quota_mb: float,
) -> DataFrame:
    """All messages of a run, ready or with the reason to skip them.

    Accounts in use are left out before the contacts are joined.
    """
    concerned = state.where(F.col("delete_status").isin(*STATUS_KINDS.values()))
    notices = status_notices(recipients(concerned, identity_history), templates)
    return notices.unionByName(quota_notices(over_quota, templates, quota_mb))


def preview(queue: DataFrame) -> DataFrame:
    """What would be sent to whom: one line per message."""
    line = F.when(
        F.col("skip_reason").isNull(),
        F.concat(
            F.upper("kind"), F.lit(" -> "), F.coalesce("username", F.lit("")), F.lit(" at "), F.col("recipient"),
            F.lit(" (cc_count="), F.col("cc_count"), F.lit(")"),
        ),
    ).otherwise(F.concat(F.lit("Skipping "), F.coalesce("username", F.lit("")), F.lit(": "), F.col("skip_reason")))
    return queue.select("kind", "username", "recipient", join_list(F.col("cc")).alias("cc_text"), "cc_count", "skip_reason", line.alias("line"))


def queue_counts(queue: DataFrame) -> DataFrame:
    """Messages and skipped ones by kind (A4)."""
    return queue.groupBy("kind").agg(
        F.count(F.lit(1)).alias("notices"), F.count("skip_reason").alias("skipped"), F.sum("cc_count").alias("copies")
    )
