"""The test tables seen as the engine's tables.

Every view is over a whole table. Where a rule needs different cases (a flag, a missing address) they are columns
derived from the rows' own values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rosterkeep.model import IDENTITY, ITEMS, MEMBERS, Layout

#: Run date, quota and address form of the bindings.
RUN_DATE = dt.date(2001, 8, 1)
QUOTA = 3_700_000
SUFFIX = "_org"
DOMAIN = "corp.example"


class Tables:
    """The test tables of one folder. A table's schema is read from its file once per process, not once per query."""

    _schemas: dict[str, T.StructType] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in self._schemas:
            self._schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self._schemas[path]).parquet(path)


def text(name: str):
    return F.col(name).cast("string")


def in_layout(df: DataFrame, layout: Layout) -> DataFrame:
    """The frame in a layout: columns it lacks are NULL."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.spark_type).alias(f.name) for f in layout.fields]
    )


# --- Members, items, state ----------------------------------------------------------------------------------------


def members(t: Tables) -> DataFrame:
    """Customers as members."""
    return t.customer.select(
        text("c_custkey").alias("username"),
        F.concat(F.lit("c"), text("c_custkey"), F.lit("@" + DOMAIN)).alias("email"),
        F.col("c_name").alias("name"),
    )


def order_items(t: Tables) -> DataFrame:
    """Orders as items of their customer; the price is the size."""
    return t.orders.select(
        text("o_orderkey").alias("item_id"),
        text("o_custkey").alias("owner"),
        F.col("o_totalprice").alias("feature_storage_size"),
        F.col("o_orderpriority").alias("item_type"),
    )


def event_items(t: Tables) -> DataFrame:
    """Events as items of their user; the largest error events have no id."""
    return t.events.select(
        F.when((F.col("event_type") != "error") | (F.col("value") <= 200), text("event_id")).alias("item_id"), text("user_id").alias("owner")
    )


def state(t: Tables) -> DataFrame:
    """Customers as accounts in all three states; flagged ones since their last order."""
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("last_order"))
    status = (F.col("c_custkey") % 3).cast("int")
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        text("c_custkey").alias("username"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit(" c"), text("c_custkey"), F.lit("@" + DOMAIN))).alias("working_email"),
        F.lit(None).cast("string").alias("manager_email"),
        status.alias("delete_status"),
        F.when(status == 1, F.col("last_order")).alias("flag_date"),
        F.lit(None).cast("date").alias("delete_date"),
        (F.col("c_custkey") % 17 == 0).alias("override"),
        F.lit(RUN_DATE).alias("updated_date"),
    )


def state_identity(t: Tables) -> DataFrame:
    """Identity rows of the accounts: affiliated, not, or unknown by nation; the segment is the group.

    Rows of some unknown ones have no user name, so their accounts have no identity row.
    """
    affiliated = F.when(F.col("c_nationkey") % 3 == 0, False).when(F.col("c_nationkey") % 3 == 1, True)
    named = affiliated.isNotNull() | (F.col("c_custkey") % 2 == 1)
    return t.customer.select(
        F.when(named, text("c_custkey")).alias("username"),
        affiliated.alias("entra_status"),
        F.col("c_mktsegment").alias("groups"),
        text("c_custkey").alias("directory_id"),
        F.lit(RUN_DATE).alias("updated_date"),
    )


def urgent_items(t: Tables) -> DataFrame:
    """Orders as items; those that are not urgent belong to nobody."""
    return order_items(t).withColumn("owner", F.when(F.col("item_type") == "1-URGENT", F.col("owner")))


def segment_whitelist(t: Tables) -> DataFrame:
    """Two of the customers' segments as whitelisted groups."""
    return t.customer.select(F.col("c_mktsegment").alias("id")).where(F.col("id").isin("BUILDING", "MACHINERY")).distinct()


# --- Directory ----------------------------------------------------------------------------------------------------


def directory(t: Tables) -> DataFrame:
    """Customers as directory users.

    Mails are shared by several users. One user in four is listed under an external principal name and has the
    organisation's address as an other mail only.
    """
    own = F.concat(F.lower("c_name"), F.lit("@" + DOMAIN))
    external = F.col("c_custkey") % 4 == 0
    return t.customer.select(
        text("c_custkey").alias("id"),
        F.when(external, F.concat(F.lit("Ext"), text("c_custkey"), F.lit("@partner.example"))).otherwise(own).alias("user_principal_name"),
        F.concat(F.lit("m"), (F.col("c_custkey") % 700).cast("string"), F.lit("@" + DOMAIN)).alias("mail"),
        F.when(external, F.array(F.upper(own), F.lit("shared@" + DOMAIN))).otherwise(F.array().cast("array<string>")).alias("other_mails"),
        F.col("c_mktsegment").alias("department"),
        F.col("c_custkey").alias("listing_pos"),
    )


def manager_edges(t: Tables) -> DataFrame:
    """Each customer managed by the one 750 further on; the last ones by nobody in the directory."""
    return t.customer.select(text("c_custkey").alias("user_id"), (F.col("c_custkey") + 750).cast("string").alias("manager_id"))


def group_edges(t: Tables) -> DataFrame:
    """Orders as memberships: the order is the group, its day the position."""
    return t.orders.select(
        text("o_custkey").alias("user_id"),
        text("o_orderkey").alias("group_id"),
        F.datediff(F.to_date("o_orderdate"), F.lit(dt.date(1990, 1, 1))).alias("pos"),
    )


def many_groups(t: Tables) -> DataFrame:
    """Orders as memberships, and the lines of a supplier as memberships of the customer of the same number."""
    lines = t.lineitem.select(
        text("l_suppkey").alias("user_id"),
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber")).alias("group_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber") + 100_000).cast("int").alias("pos"),
    )
    return group_edges(t).unionByName(lines)


def accounts(t: Tables) -> DataFrame:
    """Customers and suppliers as members to resolve; every fifth has no e-mail, suppliers are not in the directory."""
    people = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.lit("M").alias("mark")).union(
        t.supplier.select("s_suppkey", "s_name", F.lit("S"))
    )
    return people.select(
        F.concat("name", F.lit("_ORG")).alias("username"),
        F.when(F.col("key") % 5 != 0, F.concat("mark", F.col("key").cast("string"), F.lit("@" + DOMAIN))).alias("email"),
        "name",
    )


# --- History ------------------------------------------------------------------------------------------------------


def item_rows(t: Tables) -> DataFrame:
    """Line items as dated item rows; the line number is the title, which is no part of the state."""
    return in_layout(
        t.lineitem.select(
            text("l_linenumber").alias("title"),
            text("l_partkey").alias("item_id"),
            F.col("l_returnflag").alias("item_type"),
            text("l_suppkey").alias("owner"),
            F.col("l_linestatus").alias("share_level"),
            F.col("l_quantity").alias("feature_storage_size"),
            F.when(F.col("l_tax") > 0, F.col("l_tax") > 0.04).alias("is_hosted_service"),
            F.to_date("l_shipdate").alias("updated_date"),
        ),
        ITEMS,
    )


def member_rows(t: Tables) -> DataFrame:
    """Orders as dated member rows: the priority is the role, the status the login type."""
    return in_layout(
        t.orders.select(
            text("o_custkey").alias("username"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("role"),
            F.col("o_orderstatus").alias("login_type"),
            F.to_date("o_orderdate").alias("updated_date"),
        ),
        MEMBERS,
    )


def identity_rows(t: Tables) -> DataFrame:
    """Orders as dated identity rows: the priority names the manager."""
    return in_layout(
        t.orders.select(
            text("o_custkey").alias("username"),
            F.when(
                F.col("o_orderpriority") != "5-LOW", F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit("@" + DOMAIN))
            ).alias("manager_email"),
            (F.col("o_orderstatus") == "F").alias("entra_status"),
            F.to_date("o_orderdate").alias("updated_date"),
        ),
        IDENTITY,
    )
