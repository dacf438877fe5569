"""Every registered query against its SQL, on the smallest test tables."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import duckdb  # noqa: E402

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from rosterkeep.plans.queries import QUERIES  # noqa: E402
from tools.check import TABLES, compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict, _ = compare(spark, con, FOLDER, name, queries()[name], oracle_sql().get(name))
    assert verdict.startswith(("ok", "rows only")), verdict


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
