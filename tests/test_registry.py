"""Registered queries: agreement with the DuckDB twins, and plan shape."""
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def _norm(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime64"):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]")
        df[c] = df[c].map(lambda x: None if (x is None or (isinstance(x, float) and x != x)) else x).astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    s = E.queries()[name](spark, SF).toPandas()
    d = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    pd.testing.assert_frame_equal(_norm(s), _norm(d))


def test_every_query_has_oracle():
    from wattgrid.plans import registry
    assert set(registry.queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_plan_has_no_python_or_cartesian(spark, name):
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "CartesianProduct",
                "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad}"


def test_scan_prunes_columns_and_pushes_filters(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = E.queries()["day_lookup"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in plan
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan and "EqualTo(event_type,purchase)" in plan
