import datetime as dt

from pyspark.sql import functions as F

from tests.fixtures import hourly, ts
from wattgrid.functions import timecols as tc
from wattgrid.operators import dedupe as D
from wattgrid.operators import series as S
from wattgrid.operators import timeaxis as tx


def test_f1_madrid_to_utc(spark):
    df = hourly(spark, "2022-06-15 12:00:00", 3, lambda i: float(i + 1))
    out = tx.normalize_to_utc(df, "timestamp", source_tz="Europe/Madrid").orderBy("timestamp").collect()
    assert out[0]["timestamp"] == ts("2022-06-15 10:00:00")
    assert [r["value"] for r in out] == [1.0, 2.0, 3.0]


def test_f1_instant_input(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        df = spark.sql("SELECT TIMESTAMP'2022-06-15 12:00:00' AS timestamp, 1L AS value")
        out = tx.normalize_to_utc(df).collect()[0]["timestamp"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out == ts("2022-06-15 10:00:00")


def test_f2_f3_utc_and_naive_unchanged(spark):
    df = hourly(spark, "2022-06-15 12:00:00", 3)
    out = tx.normalize_to_utc(df).orderBy("timestamp").collect()
    assert out[0]["timestamp"].hour == 12


def test_f4_spine_72_rows_hourly(spark):
    sp = tx.hour_spine(spark, "2022-06-15", "2022-06-17")
    assert sp.count() == 72
    chk = S.step_check(sp.withColumn("k", F.lit(1)), ["k"]).collect()[0]
    assert chk["bad_steps"] == 0
    assert sp.agg(F.min("timestamp"), F.max("timestamp")).collect()[0][1] == ts("2022-06-17 23:00:00")


def test_spine_48_rows(spark):
    assert tx.hour_spine(spark, "2022-06-15", "2022-06-16").count() == 48


def test_keyed_spine_no_cross_join(spark):
    b = spark.createDataFrame([("ES", dt.date(2022, 6, 15), dt.date(2022, 6, 16)),
                               ("PT", dt.date(2022, 6, 15), dt.date(2022, 6, 16))],
                              "country string, first_day date, last_day date")
    sp = tx.keyed_hour_spine(b, ["country"], "first_day", "last_day")
    assert sp.count() == 96
    plan = sp._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_f5_calendar_features(spark):
    df = hourly(spark, "2022-06-15 00:00:00", 48)
    extra = hourly(spark, "2022-06-18 00:00:00", 1)
    out = tx.add_time_features(df.unionByName(extra)).orderBy("timestamp").collect()
    main = out[:48]
    assert [r["hour"] for r in main] == list(range(24)) * 2
    assert {r["month"] for r in main} == {6} and {r["year"] for r in main} == {2022}
    assert main[0]["day_of_week"] == 2 and main[24]["day_of_week"] == 3
    assert {r["quarter"] for r in main} == {2}
    assert main[0]["day_of_year"] == 166 and main[24]["day_of_year"] == 167
    assert not any(r["is_weekend"] for r in main)
    assert sum(r["in_policy"] for r in main) == 48
    assert out[48]["is_weekend"] and out[48]["day_of_week"] == 5


def test_policy_end_inclusive(spark):
    df = spark.createDataFrame([(ts("2023-12-31 23:00:00"),), (ts("2024-01-01 00:00:00"),)], "timestamp timestamp_ntz")
    out = tx.add_time_features(df).orderBy("timestamp").collect()
    assert out[0]["in_policy"] and not out[1]["in_policy"]
    ph = tx.add_phase(df, mode="three").orderBy("timestamp").collect()
    assert [r["phase"] for r in ph] == ["during", "after"]
    ph2 = tx.add_phase(df.withColumn("in_policy", F.col("timestamp") < F.lit("2024-01-01").cast("timestamp_ntz")),
                       mode="flag").orderBy("timestamp").collect()
    assert [r["phase"] for r in ph2] == ["during", "pre"]
    ph3 = tx.add_phase(df, mode="start").orderBy("timestamp").collect()
    assert [r["phase"] for r in ph3] == ["during", "during"]


def test_f6_f7_duplicates(spark):
    clean = hourly(spark, "2022-06-15 00:00:00", 24)
    assert D.keep_first(clean, ["timestamp"], ["value"]).count() == 24
    rows = [(ts("2022-06-15 01:00:00"), 1.0), (ts("2022-06-15 02:00:00"), 2.0),
            (ts("2022-06-15 02:00:00"), 3.0), (ts("2022-06-15 03:00:00"), 4.0)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, value double")
    kept = D.keep_first(df, ["timestamp"], ["value"]).orderBy("timestamp").collect()
    assert len(kept) == 3 and kept[1]["value"] == 2.0
    assert D.keep_first(df, ["timestamp"], ["value"], keep="last").orderBy("timestamp").collect()[1]["value"] == 3.0
    assert D.duplicated_rows(df, ["timestamp"]).count() == 2
    assert D.duplicate_keys(df, ["timestamp"]).collect()[0]["occurrences"] == 2


def test_f8_gaps(spark):
    rows = [(ts("2022-06-15 01:00:00"),), (ts("2022-06-15 02:00:00"),), (ts("2022-06-15 05:00:00"),)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz").withColumn("k", F.lit("ES"))
    g = S.gaps(df, ["k"]).collect()
    assert len(g) == 1
    assert g[0]["timestamp"] == ts("2022-06-15 05:00:00") and g[0]["missing_hours"] == 2
    assert g[0]["gap_hours"] == 3.0


def test_market_hours_day_lengths(spark):
    # spring (23 h), autumn (25 h, H25), ordinary day
    rows = [(dt.date(2022, 3, 27), i) for i in range(23)] + [(dt.date(2022, 10, 30), i) for i in range(25)] \
        + [(dt.date(2022, 6, 15), i) for i in range(24)]
    df = spark.createDataFrame(rows, "d date, i int")
    out = tx.hour_labels_to_timestamp(df, "d", "i", mode="market")
    per = {r["d"]: r for r in out.groupBy("d").agg(F.count_distinct("timestamp").alias("n"),
                                                   F.min("timestamp").alias("lo")).collect()}
    assert per[dt.date(2022, 3, 27)]["n"] == 23 and per[dt.date(2022, 10, 30)]["n"] == 25
    assert per[dt.date(2022, 6, 15)]["lo"] == ts("2022-06-14 22:00:00")
    assert per[dt.date(2022, 3, 27)]["lo"] == ts("2022-03-26 23:00:00")
    lab = tx.hour_labels_to_timestamp(df, "d", "i", mode="label")
    assert lab.filter(F.col("d") == dt.date(2022, 6, 15)).agg(F.min("timestamp")).collect()[0][0] \
        == ts("2022-06-15 00:00:00")


def test_session_zone_independent_hour_math(spark):
    df = hourly(spark, "2022-10-30 00:00:00", 24)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        hn = df.select(tc.hour_number("timestamp").alias("h"), tc.trunc_hour("timestamp").alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert len({r["h"] for r in hn}) == 24
    assert sorted(r["t"] for r in hn) == [ts("2022-10-30 00:00:00") + dt.timedelta(hours=i) for i in range(24)]


def test_lisbon_cast_hazard_avoided(spark):
    # 24 instants of 2022-10-30 (UTC) under a Lisbon session: a plain cast to NTZ
    # merges two of them; instant_to_utc_ntz keeps all 24.
    spark.conf.set("spark.sql.session.timeZone", "Europe/Lisbon")
    try:
        df = spark.sql("SELECT explode(sequence(TIMESTAMP'2022-10-30 00:00:00+00:00', "
                       "TIMESTAMP'2022-10-30 23:00:00+00:00', INTERVAL 1 HOUR)) AS t")
        naive = df.select(F.col("t").cast("timestamp_ntz").alias("x")).distinct().count()
        exact = df.select(tc.instant_to_utc_ntz("t").alias("x")).distinct().count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert naive == 23 and exact == 24


def test_day_range_pushes_down(spark, tmpdir_path):
    hourly(spark, "2022-06-15 00:00:00", 72).write.parquet(tmpdir_path + "/p")
    df = spark.read.parquet(tmpdir_path + "/p").filter(tc.day_range("timestamp", "2022-06-16"))
    assert df.count() == 24
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan


def test_resample_keeps_empty_periods(spark):
    rows = [(ts("2022-01-01 00:00:00"), 1.0), (ts("2022-01-03 05:00:00"), 3.0), (ts("2022-01-03 06:00:00"), 5.0)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, value double")
    d = tx.resample(df, [], "timestamp", "value", "day", ("mean", "min", "max")).orderBy("period_start").collect()
    assert [r["n"] for r in d] == [1, 0, 2]
    assert d[1]["mean"] is None and d[2]["mean"] == 4.0 and d[2]["max"] == 5.0
    m = tx.resample(df, [], "timestamp", "value", "month").collect()
    assert m[0]["period_end"] == dt.date(2022, 1, 31)


def test_handle_dst_transitions_per_series(spark):
    from wattgrid.operators.quality import handle_dst_transitions
    rows = [(ts("2022-10-30 00:00:00"), "ES", 1.0), (ts("2022-10-30 01:00:00"), "ES", 2.0),
            (ts("2022-10-30 01:00:00"), "ES", 3.0), (ts("2022-10-30 04:00:00"), "ES", 4.0),
            (ts("2022-10-30 01:00:00"), "PT", 9.0)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, v double")
    out = handle_dst_transitions(df, ["country"])
    assert out["gaps"].count() == 1 and out["duplicates"].count() == 2
    clean = out["clean"].orderBy("country", "timestamp").collect()
    assert len(clean) == 4 and [r["v"] for r in clean if r["country"] == "ES"] == [1.0, 2.0, 4.0]
    assert any(r["country"] == "PT" for r in clean)  # other series at the same hour survives (Q8)


def test_fill_period_gaps(spark):
    rows = [(ts("2022-01-01 00:00:00"), "a", 1.0), (ts("2022-04-01 00:00:00"), "a", 4.0),
            (ts("2022-02-01 00:00:00"), "b", 2.0)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, k string, v double")
    out = tx.fill_period_gaps(df, "timestamp", ["k"], "month").orderBy("k", "timestamp").collect()
    assert [(r["k"], r["timestamp"].month, r["v"]) for r in out] == \
        [("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 4, 4.0), ("b", 2, 2.0)]
    days = spark.createDataFrame([(ts("2022-01-01 00:00:00"), 1.0), (ts("2022-01-04 00:00:00"), 2.0)],
                                 "timestamp timestamp_ntz, v double")
    assert tx.fill_period_gaps(days, "timestamp", unit="day").count() == 4
