"""Versioned tables: pinned readers, whole commits, conflicts, deletes that rewrite only what they must."""
import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from wattgrid.sources.versioned import Conflict, VersionedTable
from wattgrid.schemas import PRICES_DAY_AHEAD

T0 = dt.datetime(2024, 1, 1)
KEYS = ["timestamp", "country"]


def rows(spark, days, price, country="ES"):
    return spark.createDataFrame([(T0 + dt.timedelta(days=d), country, float(price), None) for d in days], PRICES_DAY_AHEAD)


@pytest.fixture()
def table(spark, tmpdir_path):
    return VersionedTable(spark, tmpdir_path + "/prices", PRICES_DAY_AHEAD, "timestamp")


def prices(df):
    return sorted(((r["timestamp"] - T0).days, r["country"], r["price_eur_mwh"]) for r in df.collect())


def test_versions_are_pinned(spark, table):
    assert table.latest() == 0 and table.read().count() == 0
    assert table.overwrite(rows(spark, range(10), 1)) == 1
    old = table.read()
    assert table.append(rows(spark, [20], 2)) == 2 and table.overwrite(rows(spark, [5], 3)) == 3
    assert len(prices(old)) == 10 and len(prices(table.read(2))) == 11 and prices(table.read()) == [(5, "ES", 3.0)]
    assert table.versions() == [1, 2, 3] and table.commit_of(3)["operation"] == "overwrite"
    assert prices(table.read(2, T0 + dt.timedelta(days=9), T0 + dt.timedelta(days=30))) == [(9, "ES", 1.0), (20, "ES", 2.0)]


def test_columns_go_by_name_and_empty_writes_work(spark, table):
    table.append(rows(spark, [1], 1).select("energy_mwh", "price_eur_mwh", "country", "timestamp", F.lit("x").alias("extra")))
    table.append(rows(spark, [], 1))
    assert prices(table.read()) == [(1, "ES", 1.0)] and table.manifest().count() == 1
    table.overwrite(rows(spark, [], 1))
    assert table.read().count() == 0 and table.delete_where(F.lit(True)) == 3


def test_delete_rewrites_only_files_that_match(spark, table):
    for month in range(4):
        table.append(rows(spark, range(30 * month, 30 * month + 30), month))
    before = {r["file"] for r in table.manifest().collect()}
    v = table.delete_where(F.col("price_eur_mwh") == 2.0)
    after = {r["file"] for r in table.manifest().collect()}
    assert table.commit_of(v)["rewritten"] == len(before - after) and len(before & after) == len(before) - len(before - after) > 0
    assert {p for _, _, p in prices(table.read())} == {0.0, 1.0, 3.0}
    # a file that holds other rows too keeps these; a range searches only its files; NULL is no match
    v = table.delete_where(F.col("price_eur_mwh") >= 0, lo=T0 + dt.timedelta(days=25), hi=T0 + dt.timedelta(days=34))
    assert {d for d, _, _ in prices(table.read())} == set(range(25)) | set(range(35, 60)) | set(range(90, 120))
    assert table.delete_where(F.col("energy_mwh") > 0) == v and table.delete_where(F.col("country") == "PT") == v
    assert len(prices(table.read(4))) == 120


def test_replace_is_one_version(spark, table):
    table.overwrite(rows(spark, range(5), 1))
    v = table.replace_where(F.col("price_eur_mwh") == 1.0, rows(spark, range(3), 9))
    assert v == 2 and prices(table.read()) == [(d, "ES", 9.0) for d in range(3)]


def test_a_killed_writer_leaves_the_old_version(spark, table, monkeypatch):
    table.overwrite(rows(spark, range(5), 1))

    def die(*args):
        raise KeyboardInterrupt
    monkeypatch.setattr(table, "_publish", die)
    for write in (lambda: table.overwrite(rows(spark, [7], 2)), lambda: table.delete_where(F.lit(True)),
                  lambda: table.append_ignore(rows(spark, [8], 2), KEYS, ["price_eur_mwh"])):
        with pytest.raises(KeyboardInterrupt):
            write()
    again = VersionedTable(spark, table.path, PRICES_DAY_AHEAD, "timestamp")
    assert again.latest() == 1 and len(prices(again.read())) == 5
    assert again.append_ignore(rows(spark, [4, 8], 2), KEYS, ["price_eur_mwh"]) == 2
    assert prices(again.read())[-2:] == [(4, "ES", 1.0), (8, "ES", 2.0)]


def test_a_taken_number_is_a_conflict(spark, table):
    table.overwrite(rows(spark, [1], 1))
    with pytest.raises(Conflict):
        table._publish(1, {"manifest": "other"})
    assert table.commit_of(1)["manifest"] != "other" and prices(table.read()) == [(1, "ES", 1.0)]


def test_an_overtaken_insert_keeps_first_wins(spark, table, monkeypatch):
    """Another writer commits the same keys between this one's look and its commit."""
    table.overwrite(rows(spark, [0], 0))
    other = VersionedTable(spark, table.path, PRICES_DAY_AHEAD, "timestamp")
    real, done = table._publish, []

    def overtaken(version, commit):
        if not done:
            done.append(other.append_ignore(rows(spark, [1, 2], 5), KEYS, ["price_eur_mwh"]))
        real(version, commit)
    monkeypatch.setattr(table, "_publish", overtaken)
    assert table.append_ignore(rows(spark, [0, 2, 3], 7), KEYS, ["price_eur_mwh"]) == 3 and done == [2]
    assert prices(table.read()) == [(0, "ES", 0.0), (1, "ES", 5.0), (2, "ES", 5.0), (3, "ES", 7.0)]
    # an overtaken delete also removes what the other writer added
    done.clear()
    monkeypatch.setattr(table, "_publish", overtaken)
    other_rows = rows(spark, [9], 4)
    monkeypatch.setattr(other, "append_ignore", lambda *a: other.append(other_rows))
    table.delete_where(F.col("price_eur_mwh") < 7)
    assert prices(table.read()) == [(3, "ES", 7.0)]


def test_two_threads(spark, table):
    errors = []

    def load(price):
        try:
            mine = VersionedTable(spark, table.path, PRICES_DAY_AHEAD, "timestamp")
            for d in range(3):
                mine.append_ignore(rows(spark, range(d, d + 3), price), KEYS, ["price_eur_mwh"])
        except Exception as e:  # noqa: BLE001
            errors.append(e)
    threads = [threading.Thread(target=load, args=(p,)) for p in (1, 2)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    got = prices(table.read())
    assert [d for d, _, _ in got] == list(range(5)) and table.latest() == 6


def test_null_keys_and_order(spark, table):
    some = spark.createDataFrame([(None, "ES", 1.0, None), (None, "ES", 2.0, None), (T0, None, 3.0, None)], "timestamp timestamp_ntz, country string, price_eur_mwh double, energy_mwh double")
    loose = VersionedTable(spark, table.path + "-loose", some.schema, "timestamp")
    loose.append_ignore(some, KEYS, ["price_eur_mwh"])
    loose.append_ignore(some.withColumn("price_eur_mwh", F.col("price_eur_mwh") - 1), KEYS, ["price_eur_mwh"])
    assert sorted(r["price_eur_mwh"] for r in loose.read().collect()) == [1.0, 3.0]
