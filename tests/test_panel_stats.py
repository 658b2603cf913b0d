"""F9-F11 goldens: panel build, statistics, series operators on the 48-hour sample."""
import math

import numpy as np
from pyspark.sql import functions as F

from tests.fixtures import f9_prices, f10_weather, ts
from wattgrid.operators import panel as P
from wattgrid.operators import series as S
from wattgrid.operators import stats as A
from wattgrid.operators import timeaxis as tx
from wattgrid.plans import analytics as X


def _panel(spark, weather=True):
    prices = f9_prices(spark)
    spine = tx.keyed_hour_spine(tx.shared_day_bounds(prices, ["country"]), ["country"], "first_day", "last_day")
    return P.build_panel(spine, prices, f10_weather(spark) if weather else None)


def test_f9_f10_panel_shape_and_left_join(spark):
    p = _panel(spark)
    assert p.count() == 96
    per = {r["country"]: r for r in p.groupBy("country").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("temperature_c").isNull()).alias("nulls")).collect()}
    assert sorted(per) == ["ES", "PT"]
    assert per["ES"]["n"] == 48 and per["PT"]["n"] == 48
    assert per["ES"]["nulls"] == 0 and per["PT"]["nulls"] == 48
    es = [r["timestamp"] for r in p.filter("country = 'ES'").orderBy("timestamp").collect()]
    pt = [r["timestamp"] for r in p.filter("country = 'PT'").orderBy("timestamp").collect()]
    assert es == pt


def test_f9_series_statistics(spark):
    p = _panel(spark)
    s = A.group_stats(p, ["country"], "price_eur_mwh").filter("country = 'ES'").collect()[0]
    assert s["mean"] == 123.5 and s["median"] == 123.5 and math.isclose(s["std"], 14.0)
    q = A.quantiles(p, ["country"], "price_eur_mwh", [0.1, 0.9]).filter("country = 'ES'").collect()[0]
    assert math.isclose(q["q10"], 104.7) and math.isclose(q["q90"], 142.3)


def test_f9_coupling(spark):
    c = X.coupling(_panel(spark), "ES", "PT").collect()[0]
    assert math.isclose(c["correlation"], 1.0) and c["mean_diff"] == -5.0 and c["identical_hours"] == 0
    assert c["n_hours"] == 48 and c["coupling_label"] == "Strongly coupled market"


def test_f9_hourly_profile_and_peak(spark):
    prof = X.hourly_profile(_panel(spark)).filter("country = 'ES'")
    rows = {r["hour"]: r for r in prof.collect()}
    assert rows[0]["mean"] == 112.0 and rows[23]["mean"] == 135.0
    assert math.isclose(rows[5]["std"], 16.97056274847714)
    pk = X.peak_trough(X.hourly_profile(_panel(spark))).filter("country = 'ES'").collect()[0]
    assert pk["peak_hour"] == 23 and pk["trough_hour"] == 0 and pk["spread"] == 23.0


def test_f9_rolling(spark):
    r = S.rolling_stats(_panel(spark).select("country", "timestamp", "price_eur_mwh"), ["country"], "timestamp",
                        "price_eur_mwh", 24, True, bucket_hours=24)
    es = r.filter("country = 'ES'").orderBy("timestamp").collect()
    nn = [i for i, x in enumerate(es) if x["rolling_mean"] is not None]
    assert nn == list(range(12, 37))
    assert es[12]["rolling_mean"] == 111.5 and math.isclose(es[12]["rolling_std"], 7.0710678118654755)


def test_f9_duration_and_histogram(spark):
    p = _panel(spark)
    st = S.duration_steps(p, ["country"], "price_eur_mwh")
    m = S.duration_markers(st, ["country"], "price_eur_mwh").filter("country = 'ES'").collect()[0]
    assert [m["p10"], m["p25"], m["p50"], m["p75"], m["p90"]] == [143.0, 135.0, 123.0, 111.0, 104.0]
    h = A.histogram(p.filter("country = 'ES'"), [], "price_eur_mwh", bins=5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [10, 9, 10, 9, 10]


def test_histogram_edges_and_constant(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "v double")
    h = A.histogram(df, [], "v", bins=2, density=True).orderBy("bin").collect()
    assert [r["count"] for r in h] == [1, 2]  # x = max lands in the last bin
    assert math.isclose(sum(r["density"] * (r["bin_hi"] - r["bin_lo"]) for r in h), 1.0)
    c = spark.createDataFrame([(7.0,), (7.0,)], "v double")
    hc = A.histogram(c, [], "v", bins=4).orderBy("bin").collect()
    counts, edges = np.histogram([7.0, 7.0], bins=4)
    assert [r["count"] for r in hc] == list(counts) and math.isclose(hc[0]["bin_lo"], edges[0])


def test_box_stats_matches_numpy(spark):
    vals = [1.0, 2.0, 2.5, 3.0, 3.5, 4.0, 50.0, -40.0, None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    b = A.box_stats(df, [], "v").collect()[0]
    x = np.array([v for v in vals if v is not None])
    q1, q3 = np.percentile(x, [25, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert math.isclose(b["q1"], q1) and math.isclose(b["q3"], q3)
    assert b["whisker_lo"] == x[x >= lo].min() and b["whisker_hi"] == x[x <= hi].max()
    assert b["n_outliers"] == int(((x < lo) | (x > hi)).sum())


def test_arg_extremes_ties_and_nulls(spark):
    df = spark.createDataFrame([(0, 5.0), (1, 9.0), (2, 9.0), (3, None), (4, 1.0), (5, 1.0)], "hour int, mean double")
    r = A.arg_extremes(df, [], "hour", "mean").collect()[0]
    assert r["argmax_hour"] == 1 and r["argmin_hour"] == 4


def test_changes_pct_change_ffill(spark):
    vals = [1.0, None, 2.0, 0.0, 5.0]
    rows = [(ts("2022-01-01 00:00:00").replace(hour=i), "k", v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, key string, v double")
    out = S.changes(df, ["key"], "timestamp", "v", fill=True, bucket_hours=2).orderBy("timestamp").collect()
    # pandas 2.x: [NaN, 0, 100, -100, inf] -> inf is NULL here (Q7)
    assert [r["pct_change"] for r in out] == [None, 0.0, 100.0, -100.0, None]
    assert [r["diff"] for r in out] == [None, None, None, -2.0, 5.0]


def test_f11_append_filter_limit(spark, tmpdir_path):
    from wattgrid.schemas import PRICES_DAY_AHEAD
    from wattgrid.sources import sinks
    import datetime as dt
    rows = [(ts("2022-06-15 00:00:00") + dt.timedelta(hours=i), "ES", 100.0 + 5 * i, 25000.0 + 100 * i)
            for i in range(24)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, price_eur_mwh double, energy_mwh double")
    sinks.append(df.select("energy_mwh", "price_eur_mwh", "country", "timestamp"), tmpdir_path + "/t", PRICES_DAY_AHEAD)
    back = spark.read.parquet(tmpdir_path + "/t")
    assert back.columns == PRICES_DAY_AHEAD.names
    top = back.filter("country = 'ES'").orderBy("timestamp").limit(5).collect()
    assert [r["price_eur_mwh"] for r in top] == [100.0, 105.0, 110.0, 115.0, 120.0]


def test_build_main_panel_parameters(spark):
    prices = f9_prices(spark)
    p = P.build_main_panel(spark, prices, "2022-06-15", "2022-06-16", ["ES", "PT"], weather=f10_weather(spark))
    assert p.count() == 96 and p.filter("price_eur_mwh IS NULL").count() == 0
    assert p.filter("country = 'PT' AND temperature_c IS NULL").count() == 48


def test_panel_golden_sizes(spark):
    # SURVEY 7.7: 2022-01-01..2023-12-31 x {ES, PT} = 35,040 rows; 13,560 policy hours per country
    empty = spark.createDataFrame([], "timestamp timestamp_ntz, country string, price_eur_mwh double")
    p = P.build_main_panel(spark, empty, "2022-01-01", "2023-12-31", ["ES", "PT"])
    assert p.count() == 35040
    per = {r["country"]: r for r in p.groupBy("country").agg(F.count_if("in_policy").alias("d"),
                                                             F.count_if(~F.col("in_policy")).alias("pre")).collect()}
    assert per["ES"]["d"] == 13560 and per["ES"]["pre"] == 3960
    plan = p._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_flows_repeat_for_each_country(spark):
    prices = f9_prices(spark)
    flows = spark.createDataFrame([(ts("2022-06-15 03:00:00"), 7.0)], "timestamp timestamp_ntz, ES_to_FR_mw double")
    p = P.build_main_panel(spark, prices, "2022-06-15", "2022-06-16", ["ES", "PT"], flows_wide=flows)
    hit = p.filter(F.col("ES_to_FR_mw").isNotNull()).collect()
    assert sorted(r["country"] for r in hit) == ["ES", "PT"] and p.count() == 96
