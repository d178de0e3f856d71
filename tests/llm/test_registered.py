"""Registered queries of the pipeline's operators: their SQL, their rows and their plans."""

import duckdb
import pytest

from delaywright.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL, plan_text
from tests.test_oracles import TABLES, plain


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_and_plan(spark, duck, name):
    result = QUERIES[name](spark, SMALL)
    text = plan_text(result)
    for banned in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text
    columns = sorted(result.columns)
    found = sorted((tuple(plain(v) for v in r) for r in result.select(*columns).collect()), key=repr)
    assert found
    if name in ORACLES:
        cursor = duck.execute(ORACLES[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == columns
        order = [names.index(c) for c in columns]
        assert found == sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
