"""Text queries that SQL can express, against it."""

import pytest

from checks.compare import duckdb_rows, spark_rows
from martkeep.llm.oracle import SQL
from martkeep.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", SQL)
def test_query(spark, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == duckdb_rows(SF_DIR, SQL[name])


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
