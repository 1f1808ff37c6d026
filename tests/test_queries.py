"""Every registered query next to its SQL on the smallest tables, and what no plan may hold."""

import math

import pytest
from frames import SF, plan_of

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
QUERIES, ORACLES = entry.QUERIES, entry.ORACLES

# An all-pairs join or a Python step.
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapIn", "FlatMapGroups"]


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for table in "region nation customer part orders lineitem events".split():
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v

    return sorted(repr(tuple(value(r[i]) for i in order)) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql_and_its_plan_scales(spark, con, name):
    df = QUERIES[name](spark, SF)
    expected = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert normal(df.columns, df.collect()) == normal(expected.columns, expected.fetchall())
    plan = plan_of(df)
    assert not [word for word in FORBIDDEN if word in plan]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
