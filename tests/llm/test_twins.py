"""The queries of the subpackage that have an SQL twin, against it."""

import duckdb
import pytest
from compare import TEXT_TABLES, rows
from conftest import SMALL

import __spark_entry__ as entry
from lakehouse_kpis.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TEXT_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(ORACLE))
def test_equal(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    result = db.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, result.fetchall())


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(QUERIES)
