"""Row-frame rolling, coverage islands and market clearing against plain versions."""
import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattgrid.operators import series as S
from wattgrid.plans import analytics as X

T0 = dt.datetime(2024, 1, 1)
H = dt.timedelta(hours=1)


@pytest.mark.parametrize("window, center, least", [(24, True, None), (24, True, 3), (5, False, None), (1, True, None)])
def test_rolling_rows_equals_pandas_on_gaps(spark, window, center, least):
    rng = random.Random(1)
    rows = [(k, T0 + i * H, None if rng.random() < 0.05 else rng.random()) for k in ("a", "b", None) for i in range(700) if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double").repartition(5)
    got = {}
    for r in S.rolling_rows(df, ["k"], "ts", "v", window, center, least, bucket_rows=40).collect():
        got.setdefault(r["k"], {})[r["ts"]] = (r["rolling_mean"], r["rolling_std"], r["v"])
    for k in ("a", "b", None):
        s = pd.Series({t: v for kk, t, v in rows if kk == k}, dtype=float)
        roll = s.rolling(window, center=center, min_periods=least)
        mean, std = roll.mean(), roll.std()
        assert len(got[k]) == len(s)
        for t in s.index:
            for have, want in zip(got[k][t.to_pydatetime()], (mean[t], std[t])):
                assert (have is None and np.isnan(want)) or abs(have - want) < 1e-9


def test_rolling_rows_ties_and_empty(spark):
    rows = [("a", T0, float(i)) for i in range(50)] + [("a", T0 + H, 100.0)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double")
    got = sorted((r["v"], r["rolling_mean"]) for r in S.rolling_rows(df, ["k"], "ts", "v", 2, False, bucket_rows=8).collect())
    assert got[0] == (0.0, None) and got[7] == (7.0, 6.5) and got[-1] == (100.0, 74.5)
    assert S.rolling_rows(df.limit(0), ["k"], "ts", "v").count() == 0


def plain_islands(hours, step=1):
    out = []
    for h in sorted(set(hours)):
        if out and h - out[-1][1] <= step * H:
            out[-1] = (out[-1][0], h, out[-1][2] + 1)
        else:
            out.append((h, h, 1))
    return out


@pytest.mark.parametrize("bucket", [3, 168])
def test_islands(spark, bucket):
    rng = random.Random(2)
    series = {k: {T0 + i * H for i in range(400) if rng.random() < p} for k, p in (("a", 0.9), ("b", 0.95), (None, 0.8))}
    rows = [(k, h) for k, hs in series.items() for h in hs] + [("a", T0 + 5 * H)] * 200 + [("a", None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    series["a"].add(T0 + 5 * H)
    each = S.islands(df, ["k"], "ts", bucket_hours=bucket)
    got = sorted((str(r["k"]), r["start"], r["end"], r["hours"]) for r in each.collect())
    assert got == sorted((str(k), *i) for k, hs in series.items() for i in plain_islands(hs))
    joint = sorted((r["start"], r["end"], r["hours"]) for r in S.joint_islands(each, ["k"], bucket_hours=bucket).collect())
    assert joint == plain_islands(set.intersection(*series.values()))
    two = S.joint_islands(each.filter("k IS NOT NULL"), ["k"], series=2, bucket_hours=bucket)
    assert sorted((r["start"], r["end"], r["hours"]) for r in two.collect()) == plain_islands(series["a"] & series["b"])
    assert S.joint_islands(each.limit(0), ["k"]).count() == 0


def test_islands_with_a_wider_step(spark):
    hours = [T0 + i * H for i in (0, 2, 4, 7, 8)]
    got = S.islands(spark.createDataFrame([(h,) for h in hours], "ts timestamp_ntz").withColumn("k", F.lit(1)), ["k"], "ts", step_hours=2).collect()
    assert sorted((r["start"], r["end"], r["hours"]) for r in got) == plain_islands(hours, 2)


def plain_clearing(bids):
    prices = sorted({p for p, _, _ in bids})
    for p in prices:
        s = sum(q for x, q, side in bids if side == "supply" and x <= p)
        d = sum(q for x, q, side in bids if side == "demand" and x >= p)
        if s >= d:
            return (p, min(s, d)) if min(s, d) > 0 else (None, None)
    return (None, None)


def test_market_clearing(spark):
    rng = random.Random(3)
    markets = {i: [(rng.choice([-5.0, 0.0, 1.5]) + rng.randint(0, 12), float(rng.randint(0, 9)), rng.choice(("supply", "demand"))) for _ in range(rng.randint(1, 40))] for i in range(60)}
    markets[100] = [(float(rng.randint(1, 3000)) / 7, float(rng.randint(1, 5)), ("supply", "demand")[i % 2]) for i in range(3000)]  # most bids
    markets[101] = [(5.0, 10.0, "supply")]
    markets[102] = [(5.0, 10.0, "demand")]
    markets[103] = [(5.0, 10.0, "supply"), (4.0, 3.0, "demand")]
    markets[None] = [(2.0, 4.0, "supply"), (3.0, 4.0, "demand")]
    rows = [(k, *b) for k, bs in markets.items() for b in bs] + [(101, None, 1.0, "demand"), (101, 7.0, None, "demand"), (101, 7.0, 1.0, None), (101, float("nan"), 1.0, "demand"), (200, None, 1.0, "supply")]
    df = spark.createDataFrame(rows, "t long, price_eur_mwh double, quantity_mw double, bid_type string")
    got = {r["t"]: (r["clearing_price"], r["clearing_quantity"], r["supply_total"], r["demand_total"]) for r in X.market_clearing(df, ["t"], "bid_type").collect()}
    assert set(got) == set(markets)
    for k, bids in markets.items():
        assert got[k][:2] == plain_clearing(bids), k
        assert got[k][2:] == tuple(sum(q for _, q, side in bids if side == w) for w in ("supply", "demand"))


def test_panel_joins_keep_null_keys(spark):
    from wattgrid.operators import panel as P
    spine = spark.createDataFrame([(T0, "a"), (T0, None), (None, "a")], "timestamp timestamp_ntz, country string")
    prices = spark.createDataFrame([(T0, None, 5.0), (None, "a", 6.0)], "timestamp timestamp_ntz, country string, price_eur_mwh double")
    flows = spark.createDataFrame([(None, 7.0), (T0, 8.0)], "timestamp timestamp_ntz, x_mw double")
    got = {(r["timestamp"], r["country"]): (r["price_eur_mwh"], r["x_mw"]) for r in P.build_panel(spine, prices, None, flows, features=False).collect()}
    assert got == {(T0, "a"): (None, 8.0), (T0, None): (5.0, 8.0), (None, "a"): (6.0, 7.0)}
