"""Every registered query against the SQL that states its expected rows."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from threadloom.plans import registry

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
# Queries that are added from elsewhere have tests of their own.
QUERIES = {n: q for n, q in contract.queries().items() if n in registry.QUERIES}
EXPECTED = {n: sql for n, sql in contract.oracle_sql().items() if n in registry.QUERIES}


@pytest.fixture(scope="module")
def engine(data_directory):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{data_directory}/{table}.parquet'"
        )
    return connection


def test_every_statement_has_a_query():
    assert set(EXPECTED) <= set(QUERIES)
    assert set(QUERIES) - set(EXPECTED) == {"docq_random_comments"}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query(spark, engine, data_directory, name):
    df = QUERIES[name](spark, data_directory)
    columns = sorted(df.columns)
    actual = Counter(tuple(str(r[c]) for c in columns) for r in df.collect())
    result = engine.execute(EXPECTED[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(str(row[i]) for i in order) for row in result.fetchall())
    assert actual == expected


def test_random_comments(spark, data_directory):
    assert QUERIES["docq_random_comments"](spark, data_directory).count() == 2


def test_entry(spark):
    assert contract.entry(spark).columns == ["link_id", "subreddit", "comment_count"]


@pytest.mark.parametrize("name", sorted(n for n in EXPECTED if n.startswith("dirty_") and n.endswith(
    ("_raw", "_converted", "_removed"))) + ["docq_dup_subreddits_posts"])
def test_twins_of_empty_results_have_rows(spark, data_directory, name):
    assert not QUERIES[name](spark, data_directory).isEmpty()
