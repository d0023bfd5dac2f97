"""Every registered query against its SQL counterpart, and the shape of its plan."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from turnsieve.checks.compare import TABLES, compare

from .conftest import SMALL

# those of the training-data operators are tested beside their own tests
QUERIES = {k: f for k, f in entry_points.queries().items() if k not in entry_points.LLM_QUERIES}
ORACLES = {k: q for k, q in entry_points.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield con
    con.close()


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in ORACLES:
        relation = duck.sql(ORACLES[name])
        assert compare(df.columns, rows, relation.columns, relation.fetchall()) is None
