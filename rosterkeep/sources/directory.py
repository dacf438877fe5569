"""Exports of the directory: users, manager edges, group edges, whitelisted groups.

The exports are files the user supplies; JSON lines and Parquet are read by name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

USERS = (
    "id string, user_principal_name string, mail string, other_mails array<string>, department string, "
    "display_name string, listing_pos long"
)
MANAGERS = "user_id string, manager_id string"
GROUPS = "user_id string, group_id string, pos int"
WHITELIST = "id string, name string"


def _read(spark: SparkSession, path: str, schema: str, form: str) -> DataFrame:
    return spark.read.schema(schema).format(form).load(path)


def read_directory(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    return _read(spark, path, USERS, form)


def read_manager_edges(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    return _read(spark, path, MANAGERS, form)


def read_group_edges(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    return _read(spark, path, GROUPS, form)


def read_whitelist(spark: SparkSession, path: str, form: str = "json") -> DataFrame:
    """Whitelisted groups; only the id is used."""
    return _read(spark, path, WHITELIST, form).select("id")
