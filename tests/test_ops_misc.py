"""Remaining operator surface: joins, reshape, weighted/circular means, parsing."""
import datetime as dt
import math

from pyspark.sql import functions as F

from wattgrid.functions import timecols as tc
from wattgrid.operators import joins as J
from wattgrid.operators import panel as P
from wattgrid.operators import reshape as R
from wattgrid.operators import series as S
from wattgrid.operators import stats as A

T0 = dt.datetime(2022, 6, 15)


def test_parse_timestamp_heterogeneous(spark):
    df = spark.createDataFrame([("2022-06-15 12:00:00",), ("2022-06-15",), ("15/06/2022",), ("junk",), (None,)], "s string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [r["t"] for r in df.select(tc.parse_timestamp("s").alias("t")).collect()]
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == [dt.datetime(2022, 6, 15, 12), T0, T0, None, None]


def test_align_pair_inner_and_outer(spark):
    rows = [(T0, "ES", 1.0), (T0, "PT", 2.0), (T0 + dt.timedelta(hours=1), "ES", 3.0)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, p double")
    assert J.align_pair(df, "timestamp", "country", "p", "ES", "PT").count() == 1
    outer = J.align_pair(df, "timestamp", "country", "p", "ES", "PT", inner=False).orderBy("timestamp").collect()
    assert len(outer) == 2 and outer[1]["PT"] is None


def test_key_alignment_and_series_equal(spark):
    a = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "k int, v double")
    b = spark.createDataFrame([(1, 1.0), (2, float("nan")), (4, 5.0)], "k int, v double")
    both = a.withColumn("side", F.lit("a")).unionByName(b.withColumn("side", F.lit("b")))
    left, right = F.col("side") == "a", F.col("side") == "b"
    ka = J.key_alignment(both, ["k"], left, right).collect()[0]
    assert (ka["matched"], ka["only_left"], ka["only_right"], ka["aligned"]) == (2, 1, 1, False)
    eq = J.series_equal(both, ["k"], "v", left, right).collect()[0]
    assert eq["n"] == 4 and not eq["equal"] and eq["n_different"] == 2 and eq["nan_pairs"] == 1
    same = J.series_equal(a, ["k"], "v", F.lit(True), F.lit(True)).collect()[0]
    assert same["equal"]


def test_unmatched_and_overlap(spark):
    l = spark.createDataFrame([(1,), (2,), (3,)], "t int")
    r = spark.createDataFrame([(2,), (2,), (5,)], "t int")
    assert sorted(x["t"] for x in J.unmatched(l, r, ["t"]).collect()) == [1, 3]
    assert J.key_overlap(l, r, "t").collect()[0]["overlap"] == 1


def test_weather_by_country_plain_and_weighted(spark):
    w = spark.createDataFrame([(T0, "Madrid", 20.0, 270.0), (T0, "Bilbao", 10.0, 90.0), (T0, "Lisbon", 15.0, 0.0)],
                              "timestamp timestamp_ntz, location string, temperature_c double, wind_direction_100m double")
    dim = P.dimension(spark, {"Madrid": "ES", "Bilbao": "ES", "Lisbon": "PT"}, "location", "country")
    out = {r["country"]: r for r in P.weather_by_country(w, dim, ["temperature_c"]).collect()}
    assert out["ES"]["temperature_c"] == 15.0 and out["PT"]["temperature_c"] == 15.0
    dimw = dim.withColumn("weight", F.when(F.col("location") == "Madrid", 3.0).otherwise(1.0))
    ww = {r["country"]: r for r in P.weather_by_country(w, dimw, ["temperature_c"], weight_col="weight",
                                                        dim_is_literal=False).collect()}
    assert ww["ES"]["temperature_c"] == 17.5
    circ = w.filter("location != 'Lisbon'").agg(A.circular_mean_deg("wind_direction_100m").alias("d")).collect()[0]["d"]
    assert math.isclose(circ, 0.0, abs_tol=1e-9) or math.isclose(circ, 360.0, abs_tol=1e-9) or circ > 179


def test_circular_means_wrap_cancel_and_weigh(spark):
    rows = [("north", 350.0, 1.0), ("north", 10.0, 1.0), ("north", None, 5.0), ("north", float("nan"), 5.0), ("north", float("inf"), 5.0),
            ("cancel", 90.0, 2.0), ("cancel", 270.0, 2.0), ("weighed", 0.0, 3.0), ("weighed", 90.0, 1.0), ("weighed", 180.0, 0.0),
            ("weighed", 180.0, None), ("none", None, 1.0), (None, 720.0, 1.0), (None, -360.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, d double, w double")
    got = {r["k"]: (r["direction"], r["steadiness"], r["n"]) for r in A.circular_by_group(df, ["k"], "d", "w").collect()}
    assert got["north"][0] == 0.0 or got["north"][0] < 1e-9
    assert math.isclose(got["north"][1], math.cos(math.radians(10))) and got["north"][2] == 2
    assert got["cancel"][0] is None and got["cancel"][1] < 1e-9 and got["cancel"][2] == 2
    assert math.isclose(got["weighed"][0], math.degrees(math.atan2(1, 3))) and math.isclose(got["weighed"][1], math.sqrt(10) / 4) and got["weighed"][2] == 2
    assert got["none"] == (None, None, 0)
    assert got[None][0] < 1e-9 and math.isclose(got[None][1], 1.0)
    plain = {r["k"]: r["n"] for r in A.circular_by_group(df, ["k"], "d").collect()}
    assert plain["weighed"] == 4 and A.circular_by_group(df.limit(0), ["k"], "d").count() == 0


def test_describe_and_pivot_matrix(spark):
    rows = [(2022, "ES", 1.0), (2022, "ES", 3.0), (2023, "PT", 5.0)]
    df = spark.createDataFrame(rows, "year int, country string, p double")
    m = R.pivot_matrix(df, "year", "country", ["ES", "PT"], "p").orderBy("year").collect()
    assert m[0]["ES"] == 2.0 and m[0]["PT"] is None and m[1]["PT"] == 5.0
    d = {(r["country"], r["stat"]): r["value"] for r in R.describe_long(df, "country", "p").collect()}
    assert d[("ES", "count")] == 2.0 and d[("ES", "50%")] == 2.0 and d[("PT", "std")] is None
    side = {r["stat"]: r for r in R.describe_side_by_side(df, "country", "p", ["ES", "PT"], ["spain", "portugal"]).collect()}
    assert side["mean"]["spain"] == 2.0 and side["max"]["portugal"] == 5.0 and side["min"]["stat_order"] == 3
    hours = R.hourly_side_by_side(df.withColumn("hour", F.lit(3)), "country", "p", ["ES", "PT"])
    assert hours.count() == 24 and hours.filter("hour = 3").collect()[0]["ES_avg"] == 2.0


def test_add_fills_both_directions(spark):
    vals = [None, 1.0, None, None, 4.0, None]
    rows = [(T0 + dt.timedelta(hours=i), "k", v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, key string, v double")
    out = S.add_fills(df, ["key"], "timestamp", "v", bucket_hours=2).orderBy("timestamp").collect()
    assert [r["_ffill"] for r in out] == [None, 1.0, 1.0, 1.0, 4.0, 4.0]
    assert [r["_bfill"] for r in out] == [1.0, 1.0, 4.0, 4.0, 4.0, None]


def test_group_stats_and_correlation(spark):
    rows = [("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 3.0, None), ("b", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    c = {r["k"]: r for r in A.correlation(df, "x", "y", ["k"]).collect()}
    assert math.isclose(c["a"]["correlation"], 1.0) and c["a"]["n_pairs"] == 2
    g = {r["k"]: r for r in A.group_stats(df, ["k"], "x").collect()}
    assert g["a"]["median"] == 2.0 and g["b"]["std"] is None
    nc = A.null_counts(df, ["y"], ["k"]).filter("k = 'a'").collect()[0]
    assert nc["y_nulls"] == 1


def test_quantiles_approx_close_to_exact(spark):
    df = spark.range(0, 10001).select(F.col("id").cast("double").alias("v"), F.lit("k").alias("g"))
    ex = A.quantiles(df, ["g"], "v", [0.1, 0.5, 0.9]).collect()[0]
    ap = A.quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], approx=True).collect()[0]
    assert ex["q50"] == 5000.0 and ex["q10"] == 1000.0
    for c in ("q10", "q50", "q90"):
        assert abs(ap[c] - ex[c]) <= 10001 / 10000 + 1


def test_pct_change_without_fill(spark):
    vals = [1.0, None, 2.0, 4.0]
    rows = [(T0 + dt.timedelta(hours=i), "k", v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, key string, v double")
    out = S.changes(df, ["key"], "timestamp", "v", fill=False, bucket_hours=2).orderBy("timestamp").collect()
    assert [r["pct_change"] for r in out] == [None, None, None, 100.0]


def test_delete_where_keeps_null_predicate_rows(spark, tmpdir_path):
    from wattgrid.sources import sinks
    df = spark.createDataFrame([("ES", 1.0), (None, 2.0), ("PT", 3.0)], "country string, v double")
    df.write.parquet(tmpdir_path + "/t")
    kept = sinks.delete_where(spark, tmpdir_path + "/t", F.col("country") == "ES", tmpdir_path + "/t2")
    assert sorted(r["v"] for r in kept.collect()) == [2.0, 3.0]


def test_loader_keep_last(spark):
    from wattgrid.plans.loading import load_wide_prices
    from wattgrid.schemas import WIDE_PRICES
    d = dt.date(2022, 6, 15)
    a = spark.createDataFrame([(d, "PRICE_SP", *[1.0] * 24, None)], WIDE_PRICES).withColumn("source", F.lit("a"))
    b = spark.createDataFrame([(d, "PRICE_SP", *[9.0] * 24, None)], WIDE_PRICES).withColumn("source", F.lit("b"))
    last = load_wide_prices(a.unionByName(b), keep="last").collect()
    assert len(last) == 24 and {r["price_eur_mwh"] for r in last} == {9.0}
