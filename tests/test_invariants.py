"""SURVEY 5.2 invariants on the stand-in panel (driver tables, SF 0.001)."""
import os

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattgrid.operators import dedupe as D
from wattgrid.operators import series as S
from wattgrid.operators import stats as A
from wattgrid.plans import standins as SI

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def panel(spark):
    return SI.panel(spark, SF)


@needs_data
def test_panel_shape_and_keys(spark, panel):
    n_keys = SI.hourly_prices(spark, SF).select("country").distinct().count()
    b = panel.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"), F.count(F.lit(1)).alias("n")).collect()[0]
    hours = int((b["hi"] - b["lo"]).total_seconds() // 3600) + 1
    assert b["n"] == hours * n_keys
    assert panel.groupBy("timestamp", "country").count().filter("count > 1").count() == 0
    no_weather = SI.panel(spark, SF, with_weather=False)
    assert no_weather.count() == b["n"]  # left joins never change the row count


@needs_data
def test_duration_non_increasing_and_histogram_total(panel):
    curve = S.duration_rows(S.duration_steps(panel, ["country"], "price_eur_mwh"), ["country"], "price_eur_mwh") \
        .toPandas().sort_values(["country", "rank"])
    for _, g in curve.groupby("country"):
        v = g["price_eur_mwh"].dropna().to_numpy()
        assert (np.diff(v) <= 0).all()
        assert g["price_eur_mwh"].isna().to_numpy()[len(v):].all()  # NULLs last
    h = A.histogram(panel, ["country"], "price_eur_mwh", bins=30).groupBy("country").agg(F.sum("count").alias("s"))
    n = panel.groupBy("country").agg(F.count("price_eur_mwh").alias("n"))
    assert h.join(n, "country").filter("s != n").count() == 0


@needs_data
def test_scalable_rolling_equals_plain_window(panel):
    p = panel.select("country", "timestamp", "price_eur_mwh")
    w = Window.partitionBy("country").orderBy("timestamp").rowsBetween(-12, 11)
    v = F.col("price_eur_mwh")
    plain = p.select("country", "timestamp",
                     F.when(F.count(v).over(w) == 24, F.avg(v).over(w)).alias("m0"),
                     F.when(F.count(v).over(w) == 24, F.stddev_samp(v).over(w)).alias("s0"))
    scal = S.rolling_stats(p, ["country"], "timestamp", "price_eur_mwh", 24, True, bucket_hours=48)
    j = plain.join(scal, ["country", "timestamp"]).toPandas()
    assert len(j) == p.count()
    np.testing.assert_allclose(j["m0"].astype(float), j["rolling_mean"].astype(float), equal_nan=True)
    np.testing.assert_allclose(j["s0"].astype(float), j["rolling_std"].astype(float), equal_nan=True, atol=1e-9)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.floats(-50, 50, allow_nan=False)),
                min_size=1, max_size=40))
def test_keep_first_is_min_by_total_order(spark, rows):
    df = spark.createDataFrame([(k, s, v) for k, s, v in rows], "k int, src int, v double")
    got = {r["k"]: (r["src"], r["v"]) for r in D.keep_first(df, ["k"], ["src", "v"]).collect()}
    exp = pd.DataFrame(rows, columns=["k", "src", "v"]).sort_values(["src", "v"]).groupby("k").first()
    assert got == {k: (int(r.src), float(r.v)) for k, r in exp.iterrows()}
