"""Every registered query against its SQL on the smallest driver tables."""
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from workload import registry
from workload.standins import SCHEMAS

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in SCHEMAS:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    key = lambda r: tuple((v is not None, "nan" if isinstance(v, float) and math.isnan(v) else str(v)) for v in r)
    return sorted([tuple(r[i] for i in order) for r in data], key=key)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, str(SF))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = norm(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == norm(cols, cur.fetchall())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["date_key", "zone_key", "fx_key"] and df.count() > 0
