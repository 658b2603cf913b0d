"""Ambiguous local stamps (T1, T13, T14) and the shift between two key sets."""
import datetime as dt
import random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattgrid.operators import joins as J
from wattgrid.operators import timeaxis as tx

MADRID = ZoneInfo("Europe/Madrid")


def stamps(start, hours, minutes=60):
    """(utc, local text) of a market's rows in order."""
    t = dt.datetime.fromisoformat(start).replace(tzinfo=dt.timezone.utc)
    out = [t + dt.timedelta(minutes=minutes * i) for i in range(hours * 60 // minutes)]
    return [(u.replace(tzinfo=None), u.astimezone(MADRID).strftime("%Y-%m-%d %H:%M")) for u in out]


@pytest.mark.parametrize("start,hours,minutes", [("2024-10-25T22:00", 49, 60), ("2024-03-29T23:00", 48, 60), ("2023-10-28T22:00", 25, 15), ("2023-06-01T00:00", 24, 60)])
def test_true_local_stamps_come_back(spark, start, hours, minutes):
    want = stamps(start, hours, minutes)
    df = spark.createDataFrame([("ES", i, s) for i, (_, s) in enumerate(want)], "country string, line int, stamp string").repartition(3)
    got = tx.resolve_local_stamps(df, ["country"], "line", "stamp").orderBy("line").collect()
    assert [r["timestamp"] for r in got] == [u for u, _ in want]
    n = 60 // minutes
    both = [r["stamp_status"] for r in got if r["stamp_status"] != "ok"]
    assert both == (["first"] * n + ["second"] * n if "-10-" in start else [])


def test_day_lengths_of_plain_stamps(spark):
    rows = [(y, i, s) for y, start in (("a", "2024-10-26T22:00"), ("s", "2024-03-30T23:00"), ("n", "2024-06-01T22:00")) for i, (_, s) in enumerate(stamps(start, 25))]
    df = tx.resolve_local_stamps(spark.createDataFrame(rows, "k string, line int, stamp string"), ["k"], "line", "stamp")
    first = F.min(F.substring("stamp", 1, 10)).over(Window.partitionBy("k"))
    got = df.withColumn("d", first).filter(F.substring("stamp", 1, 10) == F.col("d")).groupBy("k").agg(F.countDistinct("timestamp").alias("n")).collect()
    assert {r["k"]: r["n"] for r in got} == {"a": 25, "s": 23, "n": 24}


def test_statuses_and_odd_rows(spark):
    rows = [("x", 1, "2024-10-27 02:00"), ("y", 1, "2024-10-27 02:30"), ("y", 2, "2024-10-27 02:15"), ("y", 3, "2024-10-27 02:15"), (None, 1, "2024-10-27 02:00"),
            (None, 2, "2024-10-27 02:00"), ("x", 2, "2024-03-31 02:30"), ("x", 3, "soon"), ("x", None, None), ("x", 4, "2024-10-27 03:00")]
    rows = [(*r, "clash") for r in rows]
    df = spark.createDataFrame(rows, "k string, line int, stamp string, _note string")
    got = {(r["k"], r["line"]): (r["timestamp"], r["stamp_status"]) for r in tx.resolve_local_stamps(df, ["k"], "line", "stamp").collect()}
    day = dt.datetime(2024, 10, 27)
    at = lambda h, m=0: day + dt.timedelta(hours=h, minutes=m)
    assert got == {("x", 1): (at(0), "single"), ("y", 1): (at(0, 30), "first"), ("y", 2): (at(1, 15), "second"), ("y", 3): (at(1, 15), "surplus"),
                   (None, 1): (at(0), "first"), (None, 2): (at(1), "second"), ("x", 2): (None, "nonexistent"), ("x", 3): (None, "unparsed"),
                   ("x", None): (None, "unparsed"), ("x", 4): (at(2), "ok")}
    assert {s for _, s in got.values()} == set(tx.STAMP_STATUS)
    assert tx.resolve_local_stamps(df.limit(0), ["k"], "line", "stamp").count() == 0


def brute_shift(left, right, most):
    days = sorted({t.replace(hour=0) for t in left})
    hour = dt.timedelta(hours=1)

    def off(s):
        return sum((d + h * hour in left) != (d + (h + s) * hour in right) for d in days for h in range(24))
    return min(range(-most, most + 1), key=lambda s: (off(s), abs(s), -s)), off


@pytest.mark.parametrize("seed", range(4))
def test_planted_shifts_are_named_per_month(spark, seed):
    rng = random.Random(seed)
    t0, hour = dt.datetime(2024, 2, 1), dt.timedelta(hours=1)
    left = {t0 + i * hour for i in range(24 * 85) if rng.random() < 0.7}
    plan = {2: rng.randint(-24, 24), 3: 0, 4: 1}
    right = {t + plan[t.month] * hour for t in left if rng.random() < 0.97}
    a = spark.createDataFrame([("ES", t) for t in left] + [("ES", None)], "k string, timestamp timestamp_ntz").repartition(3)
    b = spark.createDataFrame([("ES", t) for t in right for _ in range(2)], "k string, timestamp timestamp_ntz")
    got = {r["period_start"].month: r for r in J.key_shift(a, b, ["k"]).collect()}
    assert {m: r["shift_hours"] for m, r in got.items()} == plan
    for m, r in got.items():
        part = {t for t in left if t.month == m}
        best, off = brute_shift(part, right, 24)
        n = 24 * len({t.date() for t in part})
        assert best == r["shift_hours"] and abs(r["agreement"] - (1 - off(best) / n)) < 1e-12
        assert abs(r["agreement_unshifted"] - (1 - off(0) / n)) < 1e-12 and r["hours_left"] == len(part)


def test_shift_of_nothing_and_null_keys(spark):
    none = spark.createDataFrame([], "k string, timestamp timestamp_ntz")
    one = spark.createDataFrame([(None, dt.datetime(2024, 1, 1, 23)), (None, dt.datetime(1969, 12, 31, 3))], "k string, timestamp timestamp_ntz")
    late = one.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 2 HOUR"))
    assert J.key_shift(none, one, ["k"]).count() == 0
    assert {r["shift_hours"] for r in J.key_shift(one, late, ["k"]).collect()} == {2}
    alone = J.key_shift(one, none, ["k"]).collect()
    assert {r["shift_hours"] for r in alone} == {0} and all(r["hours_left"] == 1 for r in alone)
    with pytest.raises(ValueError):
        J.key_shift(one, one, ["k"], max_shift=25)
