"""Every registered query against its checking SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from delaywright.plans import all_oracles, all_queries
from tests.conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# (the queries of the training-data pipeline are held against their SQL beside their other tests)
QUERIES = all_queries()
ORACLES = all_oracles()
SEARCHES = {"tune_grid_timefold", "tune_random", "tune_mlp", "cv_random", "run_log_rows"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    columns = sorted(result.columns)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    found = sorted((tuple(plain(v) for v in r) for r in result.select(*columns).collect()), key=repr)
    assert found == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SEARCHES))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
