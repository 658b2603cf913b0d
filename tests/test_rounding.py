"""Rounding at the report boundary: no cap, half to even, noise removed."""
import duckdb
import pytest
from pyspark.sql import functions as F

from wattgrid.functions.numeric import round_even
from wattgrid.plans.oracle import rounded

CASES = [(1e13, 1e13), (5e15, 5e15), (-5e15, -5e15), (float("inf"), float("inf")), (float("-inf"), float("-inf")), (0.00000049, 0.0), (1.2345674951, 1.234567),
         (45.0160625, 45.016062), (45.01606250000001, 45.016062), (45.016062499999993, 45.016062), (45.0160635, 45.016064), (-2.5, -2.5), (1e300, 1e300), (0.1 + 0.2, 0.3)]


def test_values(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(CASES)] + [(99, None)], "i int, x double")
    got = {r["i"]: r["y"] for r in df.select("i", round_even("x").alias("y")).collect()}
    assert got.pop(99) is None
    assert [got[i] for i in range(len(CASES))] == [w for _, w in CASES]
    assert "BIGINT" not in df.select(round_even(F.col("x")))._jdf.queryExecution().toString().upper()


@pytest.mark.parametrize("x", [c[0] for c in CASES if abs(c[0]) < 1e299])
def test_same_steps_in_sql(spark, x):
    want = duckdb.sql(f"SELECT {rounded('x')} FROM (SELECT CAST('{x!r}' AS DOUBLE) AS x) t").fetchall()[0][0]
    assert spark.createDataFrame([(x,)], "x double").select(round_even("x").alias("y")).first()["y"] == want
