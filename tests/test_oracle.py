"""Every registered query against its SQL twin, on the smallest tables."""

import re

import duckdb
import pytest
from compare import TABLES, rows
from conftest import SMALL, first_plan

import __spark_entry__ as entry
from oracle.sql import ORACLE

# the training-data queries are checked in tests/llm
QUERIES = {
    n: q for n, q in entry.queries().items() if n != "pipeline" and not re.match(r"op\d+_", n)
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_equal(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    result = db.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    plan = first_plan(df)
    for costly in ("Python", "Pandas", "CartesianProduct", "NestedLoop"):
        assert costly not in plan
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, result.fetchall())
