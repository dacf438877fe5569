"""The queries over training text that have SQL, against it."""

import duckdb
import pytest

from helpers import SMALL, needs_tables
from rosterkeep.llm.queries import ORACLE, QUERIES
from tools.check import TABLES, compare

pytestmark = pytest.mark.skipif(needs_tables(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    verdict, _ = compare(spark, con, SMALL, name, QUERIES[name], ORACLE[name])
    assert verdict.startswith("ok"), verdict


def test_one_query_for_each_operator():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
