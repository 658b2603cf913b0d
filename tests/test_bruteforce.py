"""Bucketed (skew-safe) series operators against plain pandas on random data.

Small bucket sizes force many bucket edges, halos and cross-bucket carries.
"""
import datetime as dt

import numpy as np
import pandas as pd
import pytest

from wattgrid.operators import joins as J
from wattgrid.operators import series as S

T0 = dt.datetime(2024, 1, 1)


def _series(seed, n=200, keys=("a", "b", "c"), null_rate=0.2):
    rng = np.random.default_rng(seed)
    rows = []
    for k in keys:
        for i in range(n):
            v = None if rng.random() < null_rate else float(rng.integers(0, 40)) / 4  # ties on purpose
            rows.append((T0 + dt.timedelta(hours=i), k, v))
    return rows


@pytest.mark.parametrize("bucket", [24, 37, 1000])
def test_rolling_matches_pandas(spark, bucket):
    rows = _series(1)
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, k string, v double")
    got = S.rolling_stats(df, ["k"], "timestamp", "v", 24, True, bucket_hours=bucket).toPandas()
    pdf = pd.DataFrame(rows, columns=["timestamp", "k", "v"])
    for k, g in pdf.groupby("k"):
        g = g.sort_values("timestamp")
        exp_m = g["v"].rolling(24, center=True).mean().to_numpy()
        exp_s = g["v"].rolling(24, center=True).std().to_numpy()
        mine = got[got.k == k].sort_values("timestamp")
        np.testing.assert_allclose(mine["rolling_mean"].astype(float).to_numpy(), exp_m, equal_nan=True)
        np.testing.assert_allclose(mine["rolling_std"].astype(float).to_numpy(), exp_s, equal_nan=True, atol=1e-9)


@pytest.mark.parametrize("bucket", [3, 50])
def test_changes_match_pandas(spark, bucket):
    rows = _series(2, null_rate=0.4)
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, k string, v double")
    got = S.changes(df, ["k"], "timestamp", "v", fill=True, bucket_hours=bucket).toPandas()
    pdf = pd.DataFrame(rows, columns=["timestamp", "k", "v"])
    for k, g in pdf.groupby("k"):
        g = g.sort_values("timestamp")
        f = g["v"].ffill()
        exp_pct = ((f / f.shift(1)) - 1) * 100
        exp_pct[f.isna()] = np.nan
        exp_pct = exp_pct.replace([np.inf, -np.inf], np.nan)
        exp_diff = g["v"].diff()
        mine = got[got.k == k].sort_values("timestamp")
        np.testing.assert_allclose(mine["pct_change"].astype(float).to_numpy(), exp_pct.to_numpy(), equal_nan=True)
        np.testing.assert_allclose(mine["diff"].astype(float).to_numpy(), exp_diff.to_numpy(), equal_nan=True)


def test_duration_matches_sorted_series(spark):
    rows = _series(3, n=150)
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, k string, v double")
    steps = S.duration_steps(df, ["k"], "v")
    curve = S.duration_rows(steps, ["k"], "v", chunk=7).toPandas()
    marks = S.duration_markers(steps, ["k"], "v").toPandas().set_index("k")
    pdf = pd.DataFrame(rows, columns=["timestamp", "k", "v"])
    for k, g in pdf.groupby("k"):
        srt = g["v"].sort_values(ascending=False, na_position="last").reset_index(drop=True)
        mine = curve[curve.k == k].sort_values("rank")
        assert list(mine["rank"]) == list(range(len(srt)))
        np.testing.assert_allclose(mine["v"].astype(float).to_numpy(), srt.to_numpy(dtype=float), equal_nan=True)
        np.testing.assert_allclose(mine["position"].to_numpy(), np.arange(len(srt)) * 100 / len(srt))
        for p in (10, 25, 50, 75, 90):
            exp = srt.iloc[int(p * len(srt) / 100)]
            got = marks.loc[k, f"p{p}"]
            assert (pd.isna(exp) and pd.isna(got)) or exp == got


def test_gaps_match_pandas(spark):
    rng = np.random.default_rng(4)
    rows = []
    for k in ("a", "b"):
        t = T0
        for _ in range(120):
            t = t + dt.timedelta(hours=int(rng.choice([1, 1, 1, 2, 5, 30])))
            rows.append((t, k))
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, k string")
    got = S.gaps(df, ["k"], bucket_hours=5).toPandas()
    pdf = pd.DataFrame(rows, columns=["timestamp", "k"])
    exp = 0
    for _, g in pdf.groupby("k"):
        d = g.sort_values("timestamp")["timestamp"].diff()
        exp += int((d > pd.Timedelta(hours=1.5)).sum())
    assert len(got) == exp
    assert (got["missing_hours"] == got["gap_hours"].round().astype(int) - 1).all()


def test_nearest_match_brute_force(spark):
    rng = np.random.default_rng(5)
    left, right = [], []
    for k in ("a", "b", "c"):
        for i in rng.choice(500, 60, replace=False):
            left.append((k, T0 + dt.timedelta(minutes=int(i) * 37)))
        if k != "c":
            for i in rng.choice(500, 25, replace=False):
                right.append((k, T0 + dt.timedelta(minutes=int(i) * 53)))
    l = spark.createDataFrame(left, "k string, timestamp timestamp_ntz")
    r = spark.createDataFrame(right, "k string, timestamp timestamp_ntz")
    got = J.nearest_match(l, r, ["k"], bucket_hours=6).toPandas().set_index(["k", "timestamp"])
    rp = pd.DataFrame(right, columns=["k", "t"])
    for k, t in set(left):
        cand = rp[rp.k == k]["t"]
        row = got.loc[(k, pd.Timestamp(t))]
        if cand.empty:
            assert pd.isna(row["nearest"])
            continue
        dist = (cand - t).abs()
        best = cand[dist == dist.min()].min()  # earliest on a tie
        assert pd.Timestamp(row["nearest"]) == best
        assert row["diff_seconds"] == int((best - t).total_seconds())


@pytest.mark.parametrize("descending", [False, True])
def test_prefix_sum_hot_group(spark, descending):
    rng = np.random.default_rng(6)
    rows = [("hot", float(x), float(q)) for x, q in zip(rng.choice(5000, 3000, replace=False) / 7.0,
                                                      rng.integers(1, 9, 3000))]
    rows += [("cold", float(x), 1.0) for x in range(5)] + [("cold", None, 2.0)]
    df = spark.createDataFrame(rows, "g string, p double, q double")
    got = S.prefix_sum(df, ["g"], "p", "q", descending=descending, total_col="tot").toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "p", "q"])
    for g, grp in pdf.groupby("g"):
        srt = grp.sort_values("p", ascending=not descending, na_position="last")
        exp = srt["q"].cumsum() - srt["q"]
        mine = got[got.g == g].set_index("p", drop=False)
        for (p, e) in zip(srt["p"], exp):
            row = mine[mine["p"].isna()] if pd.isna(p) else mine.loc[[p]]
            assert float(row["sum_before"].iloc[0]) == e
        assert (got[got.g == g]["tot"] == grp["q"].sum()).all()


def test_trailing_rolling_matches_pandas(spark):
    rows = _series(7, n=120)
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, k string, v double")
    got = S.rolling_stats(df, ["k"], "timestamp", "v", 6, center=False, min_periods=3, bucket_hours=10).toPandas()
    pdf = pd.DataFrame(rows, columns=["timestamp", "k", "v"])
    for k, g in pdf.groupby("k"):
        g = g.sort_values("timestamp")
        mine = got[got.k == k].sort_values("timestamp")
        np.testing.assert_allclose(mine["rolling_mean"].astype(float).to_numpy(),
                                   g["v"].rolling(6, min_periods=3).mean().to_numpy(), equal_nan=True)


def test_duration_drop_nulls(spark):
    rows = _series(8, n=80)
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, k string, v double")
    curve = S.duration_rows(S.duration_steps(df, ["k"], "v", drop_nulls=True), ["k"], "v").toPandas()
    pdf = pd.DataFrame(rows, columns=["timestamp", "k", "v"]).dropna()
    for k, g in pdf.groupby("k"):
        srt = g["v"].sort_values(ascending=False).to_numpy()
        mine = curve[curve.k == k].sort_values("rank")
        np.testing.assert_allclose(mine["v"].to_numpy(dtype=float), srt)
        np.testing.assert_allclose(mine["position"].to_numpy(), np.arange(len(srt)) * 100 / len(srt))


def test_nearest_match_exact_hit_and_tie(spark):
    l = spark.createDataFrame([("a", T0 + dt.timedelta(hours=2)), ("a", T0 + dt.timedelta(hours=5))],
                              "k string, timestamp timestamp_ntz")
    r = spark.createDataFrame([("a", T0 + dt.timedelta(hours=2)), ("a", T0 + dt.timedelta(hours=4)),
                               ("a", T0 + dt.timedelta(hours=6))], "k string, timestamp timestamp_ntz")
    got = {row["timestamp"].hour: (row["nearest"].hour, row["diff_seconds"])
           for row in J.nearest_match(l, r, ["k"], bucket_hours=1).collect()}
    assert got[2] == (2, 0) and got[5] == (4, -3600)  # exact hit; tie resolved to the earlier one
