"""The stored panel follows arrivals: any order, late days, new series, failed updates, work by the arrival's size."""
import datetime as dt
import itertools
import random
import uuid

import pytest
from pyspark.sql import functions as F

from wattgrid.operators import panel as P
from wattgrid.operators import series as S
from wattgrid.operators import timeaxis as tx
from wattgrid.plans.incremental_panel import StoredPanel

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "timestamp timestamp_ntz, country string, price_eur_mwh double"


def hours(days, country="ES", drop=0.05, seed=0):
    rng = random.Random(f"{seed}{country}{list(days)}")
    return [(T0 + dt.timedelta(days=d, hours=h), country, round(rng.random() * 100, 2)) for d in days for h in range(24) if rng.random() >= drop]


def new(spark):
    return StoredPanel(spark, "panel-" + uuid.uuid4().hex, policy=("2024-03-03", "2024-03-05"))


def content(df):
    return sorted((r["timestamp"], r["country"], r["price_eur_mwh"], *(None if r[c] is None else round(r[c], 6) for c in ("rolling_mean", "rolling_std")),
                   r["hour"], r["day_of_week"], r["is_weekend"], r["in_policy"]) for r in df.collect())


def full(spark, rows):
    """One build from all prices."""
    df = spark.createDataFrame(rows, SCHEMA)
    spine = P.country_hour_spine(spark, min(r[0] for r in rows).date(), max(r[0] for r in rows).date(), sorted({r[1] for r in rows}))
    out = S.rolling_stats(P.build_panel(spine, df, features=False), ["country"], "timestamp", "price_eur_mwh", 24)
    return content(tx.add_time_features(out, "timestamp", ("2024-03-03", "2024-03-05")))


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[1::2])
def test_any_order_gives_the_full_build(spark, order):
    parts = [hours([0, 1, 2, 9]) + hours([1], "PT"), hours([3, 5]) + hours([2, 3], "PT"), hours([4, 8, 12]) + hours([0], "FR")]
    stored = new(spark)
    for i in order:
        stored.arrive(spark.createDataFrame(parts[i], SCHEMA))
    assert content(stored.read()) == full(spark, [r for p in parts for r in p])


def test_work_follows_the_arrival(spark):
    stored = new(spark)
    rows = []
    for month in range(4):
        part = [r for r in hours(range(30 * month, 30 * month + 30)) if r[0] != T0 + dt.timedelta(days=45, hours=5)]
        rows += part
        stored.arrive(spark.createDataFrame(part, SCHEMA))
    before = {r["file"]: r["rows"] for r in stored.panel.manifest().collect()}
    late = [(T0 + dt.timedelta(days=45, hours=5, minutes=30), "ES", 1.5)]
    days = stored.arrive(spark.createDataFrame(late + rows[:50], SCHEMA))  # the repeats are ignored
    d = late[0][0].date()
    assert days == [d - dt.timedelta(days=1), d, d + dt.timedelta(days=1)]
    after = {r["file"] for r in stored.panel.manifest().collect()}
    gone = {f: n for f, n in before.items() if f not in after}
    assert 0 < sum(gone.values()) <= 30 * 24 + 48 < sum(before.values()) / 2  # files of about one arrival
    assert content(stored.read()) == full(spark, rows + [(late[0][0].replace(minute=0), "ES", 1.5)])
    assert stored.update() == [] and stored.arrive(spark.createDataFrame(rows[:5], SCHEMA)) == []


def test_a_failed_update_is_made_up_for(spark, monkeypatch):
    stored = new(spark)
    stored.arrive(spark.createDataFrame(hours([0, 1]), SCHEMA))
    monkeypatch.setattr(stored, "update", lambda: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        stored.arrive(spark.createDataFrame(hours([2]), SCHEMA))
    monkeypatch.undo()
    assert len(content(stored.read())) == 48
    stored.arrive(spark.createDataFrame(hours([5]), SCHEMA))
    assert content(stored.read()) == full(spark, hours([0, 1]) + hours([2]) + hours([5]))


def test_nulls_and_nothing(spark):
    stored = new(spark)
    assert stored.arrive(spark.createDataFrame([], SCHEMA)) == [] and stored.read().count() == 0
    rows = [(None, "ES", 1.0), (T0, None, 1.0), (T0, "ES", None)]
    assert stored.arrive(spark.createDataFrame(rows, SCHEMA)) == [T0.date()]
    assert stored.read().count() == 24 and stored.read(lo=T0 + dt.timedelta(hours=22)).count() == 2
