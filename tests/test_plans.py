"""What the physical plans must and must not hold."""

import re
from pathlib import Path

import pytest
from conftest import RUN_DATE
from pyspark.sql import functions as F

from rosterkeep.operators import identity, latest, lifecycle, notify, quota
from rosterkeep.operators.keys import mark_listed, missing_from
from rosterkeep.plans.queries import QUERIES
from rosterkeep.sources.store import Store

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

#: Queries that write tables and run jobs before they return: the plan of what they return is looked at.
WRITING = {
    "csv_round_trip", "report_intake", "report_parts", "written_reports", "directory_exports", "whitelist_export", "template_files",
    "projected_scan", "versioned_table", "history_incremental", "history_compacted", "streaming_intake", "streaming_rewritten",
    "whole_run", "second_run",
}


@pytest.fixture
def plan(spark):
    """Physical plan as text, with joins as they are when no side is small."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    yield text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"whole_run", "second_run"}))
def test_no_python_no_forced_broadcast_no_product(spark, plan, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for unwanted in ("Python", "ArrowEval", "Cartesian", "BroadcastNestedLoop"):
        assert unwanted not in text, f"{name}: {unwanted}"
    assert "BroadcastHashJoin" not in text, name
    if "keys=[]" not in text and "key=[]" not in text:  # but for a total over partial totals, or the newest date
        assert "SinglePartition" not in text, name


def test_scan_reads_only_what_is_needed(spark, plan):
    text = plan(QUERIES["over_quota_report"](spark, FOLDER))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_filters_reach_the_scan(spark, plan):
    text = plan(QUERIES["over_quota_report"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(o_custkey)]" in text


def test_items_are_summed_before_the_join(spark, plan):
    text = plan(QUERIES["over_quota_report"](spark, FOLDER))
    join = text.index("SortMergeJoin")
    assert text.index("partial_sum") > join and text.index("partial_count") > join


def test_history_without_other_columns_is_a_hash_aggregate(spark, plan):
    text = plan(QUERIES["history_members"](spark, FOLDER))
    assert "SortAggregate" not in text and text.count("Exchange") == 1


def test_candidates_are_shuffled_once(spark, plan):
    text = plan(QUERIES["address_resolution"](spark, FOLDER))
    assert text.count("posexplode") <= 2  # accounts of two tables
    assert text.count("Exchange hashpartitioning") <= 9


def test_item_history_is_shuffled_once(spark, plan):
    assert plan(QUERIES["history_items"](spark, FOLDER)).count("Exchange") == 1


def test_whole_history_is_a_hash_aggregate(spark, plan, tmp_path):
    from rosterkeep.model import IDENTITY
    from rosterkeep.operators import history

    df = spark.createDataFrame([], IDENTITY.schema).withColumn("open", F.lit(True))
    assert "SortAggregate" not in plan(history.whole_history(df, IDENTITY))


def test_newest_snapshot_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("day", F.expr("date_add(date'2026-01-01', int(id % 10))")).write.partitionBy("day").parquet(path)
    df = latest.newest_snapshot(spark.read.parquet(path), "day")
    assert df.count() == 10
    assert "PartitionFilters: [isnotnull(day" in df._jdf.queryExecution().executedPlan().toString()


def test_fold_reads_only_open_states(spark, tmp_path):
    from rosterkeep.model import IDENTITY
    from rosterkeep.operators import history
    from rosterkeep.plans.bindings import in_layout

    store = Store(spark, str(tmp_path))
    df = in_layout(spark.sql("select 'a' as username, date'2026-01-01' as updated_date"), IDENTITY)
    for _ in range(3):
        store.add_fold("identity", history.fold_open(None, [df], IDENTITY))
    opened = store.open_states("identity")
    files = opened.inputFiles()
    assert files and all("/part=000003-" in f and "/open=true/" in f for f in files)
    assert opened.count() == 1


@pytest.fixture
def skewed(spark):
    """Session in which a partition counts as skewed at test size."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_rows(spark, rows=60_000):
    """Rows of which a third have the same key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id")))
    return spark.range(0, rows, 1, 8).select(key.alias("key"), F.col("id").cast("string").alias("id"))


def accounts_in(spark):
    """State rows of which a third are of one user."""
    day = F.lit(RUN_DATE)
    none = F.lit(None).cast("string")
    return hot_rows(spark).select(
        F.col("key").alias("username"), F.col("id").alias("name"), F.col("key").alias("working_email"), none.alias("manager_email"),
        F.lit(0).alias("delete_status"), day.alias("flag_date"), day.alias("delete_date"), F.lit(False).alias("override"), day.alias("updated_date"),
    )


def check_split(df, condition, expected):
    assert "skew=true" in executed(df)
    assert df.where(condition).count() == expected


def test_hot_account_in_the_transition(spark, skewed):
    none = F.lit(None).cast("string")
    state = accounts_in(spark)
    known = state.select("username", F.lit(False).alias("entra_status"), none.alias("groups"), none.alias("directory_id"), "updated_date")
    facts = lifecycle.account_facts(known, known.limit(0).select("username"), known.limit(0).select(F.col("username").alias("id")))
    check_split(lifecycle.transition(state, facts, RUN_DATE), "rule = 'R3'", 60_000)


def test_hot_address_in_the_overrides(spark, skewed):
    asked = hot_rows(spark).select(F.col("key").alias("working_email"), F.lit(True).alias("override"))
    check_split(lifecycle.apply_overrides(accounts_in(spark), asked), "override", 60_000)


def test_hot_account_among_the_recipients(spark, skewed):
    seen = hot_rows(spark).select(F.col("key").alias("username"), F.lit("m@d").alias("manager_email"), F.lit(RUN_DATE).alias("updated_date"))
    check_split(notify.recipients(accounts_in(spark), seen), "size(manager_emails) = 1", 60_000)


def test_hot_member_in_the_quota(spark, skewed):
    members = hot_rows(spark).select(F.col("key").alias("username"), F.col("id").alias("email"), F.lit("n").alias("name"))
    items = hot_rows(spark).select(F.col("key").alias("owner"), F.lit(1.0).alias("feature_storage_size"))
    check_split(quota.over_quota(members, items, 0), "username = 'hot'", 20_000)


def test_hot_address_in_the_resolution(spark, skewed):
    accounts = hot_rows(spark).select(F.col("id").alias("username"), F.concat("key", F.lit("@d")).alias("email"))
    people = hot_rows(spark).select("id", F.concat("key", F.lit("@d")).alias("user_principal_name"))
    users = people.select(
        "id", "user_principal_name", F.lit(None).cast("string").alias("mail"), F.array().cast("array<string>").alias("other_mails"),
        F.lit("Law").alias("department"), F.col("id").cast("long").alias("listing_pos"),
    )
    check_split(identity.resolve(accounts, users, ["email"]), "user_id = '0'", 20_000)


def test_hot_manager(spark, skewed):
    edges = hot_rows(spark).select(F.col("id").alias("user_id"), F.col("key").alias("manager_id"))
    people = hot_rows(spark).select(F.col("key").alias("id"), F.lit("m@d").alias("mail"), F.lit("Law").alias("department"), F.col("id").alias("listing_pos"))
    check_split(identity.managers(edges, people), "manager_email = 'm@d'", 60_000)


def test_hot_group_in_the_whitelist(spark, skewed):
    edges = hot_rows(spark).select(F.col("id").alias("user_id"), F.col("key").alias("group_id"))
    check_split(lifecycle.whitelisted_directory_users(edges, hot_rows(spark).select(F.col("key").alias("id"))), "true", 60_000)


def test_hot_group_in_the_marker(spark, skewed):
    rows_in = hot_rows(spark)
    marked = mark_listed(rows_in, F.col("key"), F.col("listed"), rows_in.select(F.col("key").alias("listed")), "hit", F.col("id"))
    check_split(marked, "hit", 60_000)


def test_hot_user_among_new_accounts(spark, skewed):
    known = hot_rows(spark).where("key != 'hot'").select(F.col("key").alias("username"))
    check_split(missing_from(accounts_in(spark), known, "username"), "username = 'hot'", 20_000)
