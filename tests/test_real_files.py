"""Wide files as other tools write them; calendars, hours before 1970 and gap filling across years."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from wattgrid.functions import timecols as tc
from wattgrid.operators import panel as P
from wattgrid.operators import quality as Q
from wattgrid.operators import timeaxis as tx
from wattgrid.sources import files


@pytest.mark.parametrize("date_type,expr", [("date", "DATE '2024-03-05'"), ("ntz", "TIMESTAMP_NTZ '2024-03-05 00:00:00'"), ("zoned", "TIMESTAMP '2024-03-05 00:00:00'"),
                                            ("iso text", "'2024-03-05'"), ("day first", "'05/03/2024'"), ("with time", "'2024-03-05 00:00:00'")])
def test_date_in_any_form(spark, tmpdir_path, date_type, expr):
    cols = ", ".join(f"{i} AS H{i}" for i in range(1, 25))  # integer hours, no H25
    spark.sql(f"SELECT {expr} AS DATE, 'PRICE_SP' AS CONCEPT, {cols}").write.parquet(tmpdir_path + "/f")
    r = files.read_wide_prices(spark, tmpdir_path + "/f").first()
    assert r["DATE"] == dt.date(2024, 3, 5) and r["H1"] == 1.0 and r["H24"] == 24.0 and r["H25"] is None and "/f/part-" in r["source"]


def test_files_of_different_types_as_a_list(spark, tmpdir_path):
    spark.sql("SELECT '2024-03-05' AS DATE, 'PRICE_SP' AS CONCEPT, 1 AS H1").write.parquet(tmpdir_path + "/a")
    spark.sql("SELECT DATE '2024-03-06' AS DATE, 'PRICE_PT' AS CONCEPT, double('NaN') AS H1, 9.5 AS H25").write.parquet(tmpdir_path + "/b")
    rows = files.read_wide_prices(spark, [tmpdir_path + "/a", tmpdir_path + "/b"]).orderBy("DATE").collect()
    assert [(r["DATE"].day, r["H1"], r["H25"]) for r in rows] == [(5, 1.0, None), (6, None, 9.5)]


def test_hours_before_1970_round_down(spark):
    rows = [(dt.datetime(1969, 12, 31, 22, 30),), (dt.datetime(1969, 12, 31, 23, 0),), (dt.datetime(1900, 1, 1, 0, 0, 1),), (dt.datetime(2024, 1, 1, 5, 59, 59, 999999),)]
    got = [r["h"] for r in spark.createDataFrame(rows, "t timestamp_ntz").select(tc.trunc_hour("t").alias("h")).collect()]
    assert got == [t.replace(minute=0, second=0, microsecond=0) for t, in rows]


def test_expected_calendar(spark):
    df = spark.createDataFrame([(dt.date(2022, 5, 1),), (dt.date(2030, 1, 1),), (None,)], "d date")
    out = {r["label"]: (r["days_landed"], r["expected"]) for r in files.arrival_coverage(df, "d", start="2021-11-15", end="2022-12-31").collect()}
    assert out == {"2021Q4": (0, True), "2022Q1": (0, True), "2022Q2": (1, True), "2022Q3": (0, True), "2022Q4": (0, True), "2030Q1": (1, False)}
    assert files.arrival_coverage(df.limit(0), "d").count() == 0


@pytest.mark.parametrize("unit", ["day", "month"])
def test_gaps_filled_across_years(spark, unit):
    days = [dt.datetime(2021, 11, 1), dt.datetime(2022, 1, 1), dt.datetime(2024, 3, 1)]
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)], "t timestamp_ntz, v double")
    got = tx.fill_period_gaps(df, "t", unit=unit).orderBy("t").collect()
    n = 29 if unit == "month" else (days[-1] - days[0]).days + 1
    assert len(got) == n and [r["v"] for r in got if r["v"] is not None] == [0.0, 1.0, 2.0]
    keyed = tx.fill_period_gaps(df.withColumn("k", F.lit(None).cast("string")), "t", ["k"], unit)
    assert keyed.count() == n and keyed.columns == ["t", "k", "v"]


def test_unmapped_locations_can_be_kept(spark):
    w = spark.createDataFrame([(dt.datetime(2024, 1, 1), "L1", 1.0), (dt.datetime(2024, 1, 1), "L-3", 5.0)], "timestamp timestamp_ntz, location string, t double")
    dim = P.dimension(spark, {"L1": "ES"}, "location", "country")
    assert {r["country"] for r in P.weather_by_country(w, dim, ["t"]).collect()} == {"ES"}
    assert {(r["country"], r["t"]) for r in P.weather_by_country(w, dim, ["t"], unmapped="none").collect()} == {("ES", 1.0), ("none", 5.0)}


def test_merge_diagnosis_in_one_pass(spark):
    l = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "a"), (3, "b")], "t int, k string")
    r = spark.createDataFrame([(1, "a"), (None, "a"), (3, "c"), (9, "a")], "t int, k string")
    got = Q.merge_diagnosis(l, r, ["t", "k"], "t").first().asDict()
    assert got == {"left_rows": 5, "unmatched": 2, "left_timestamps": 4, "right_timestamps": 4, "overlap": 3, "matched": 3}
    assert Q.merge_diagnosis(l.limit(0), r, ["t", "k"], "t").first()["left_rows"] == 0


def test_bounds_on_means(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 90.0), ("b", 70.0), ("c", None)], "k string, v double")
    assert {r["k"]: r["within"] for r in Q.mean_bounds(df, {"v": (0.0, 60.0)}, ["k"]).collect()} == {"a": True, "b": False, "c": None}
