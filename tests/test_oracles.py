"""Every registered query against its DuckDB statement, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from oracles import all_statements
from tidemart.plans.registry import all_queries
from tools.verify import TABLES, difference, rows_of

FOLDER = "/root/testdata/sf0.001"
QUERIES, STATEMENTS = all_queries(), all_statements()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_a_statement():
    assert set(STATEMENTS) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert {f"q{i:03d}" for i in range(1, 101)} <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(STATEMENTS[name])
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    assert difference(rows_of(df.columns, df.collect()), theirs) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
