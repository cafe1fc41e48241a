"""Every registered query against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from helpers import SF001, plan_of

QUERIES, SQL = driver._telemetry_queries(), driver._telemetry_sql()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF001}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


def cells(row, names):
    return tuple(
        "NaN" if isinstance(v, float) and math.isnan(v) else repr(float(v)) if isinstance(v, float) else repr(v)
        for v in (row[i] for i in sorted(range(len(names)), key=names.__getitem__))
    )


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, SF001)
    found = oracle.execute(SQL[name])
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(cells(r, names) for r in found.fetchall())
    assert sorted(cells(r, df.columns) for r in df.collect()) == want
    assert want


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= driver.queries().keys()
    assert SQL.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()


def test_entry(spark):
    assert driver.entry(spark).columns == ["ts", "vault_id", "count", "mean_s194", "stddev_s194"]


@pytest.mark.parametrize(
    "name,filters",
    [
        ("q1_3d", ["GreaterThanOrEqual(user_id,0)", "LessThanOrEqual(user_id,20)"]),
        ("q2_3d", ["EqualTo(event_type,error)"]),
        ("q2_daily_failures", ["EqualTo(event_type,error)"]),
    ],
)
def test_filters_and_columns_reach_the_scan(spark, name, filters):
    df = QUERIES[name](spark, SF001)
    scan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert all(f in scan for f in filters)
    assert "props" not in scan


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF001))
    for bad in ("Python", "Pandas", "Cartesian", "NestedLoop"):
        assert bad not in plan
