import datetime as dt

from pyspark.sql import functions as F

from wattgrid.operators import quality as Q
from wattgrid.schemas import WIDE_PRICES
from wattgrid.sources import catalog


def test_expectations_single_pass(spark):
    rows = [(dt.datetime(2022, 1, 1, h), "ES", p) for h, p in enumerate([10.0, None, -1.0, 2000.0, 5.0])]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, price_eur_mwh double")
    out = {r["rule"]: r for r in Q.expectations(df, Q.panel_rules(), {"price_present": 0.3}).collect()}
    assert out["price_in_range"]["checked"] == 4 and out["price_in_range"]["failed"] == 2
    assert not out["price_in_range"]["passed"]
    assert out["price_present"]["failed"] == 1 and out["price_present"]["passed"]  # 20% <= 30%


def test_weather_rules_and_wide_schema(spark):
    df = spark.createDataFrame([(25.0, 10.0, 500.0), (60.0, -1.0, None)],
                               "temperature_c double, wind_speed_100m double, solar_radiation double")
    out = {r["rule"]: r for r in Q.expectations(df, Q.weather_rules()).collect()}
    assert out["temperature_in_range"]["failed"] == 1 and out["wind_in_range"]["failed"] == 1
    assert out["radiation_in_range"]["checked"] == 1
    wide = spark.createDataFrame([], WIDE_PRICES)
    assert all(Q.wide_schema_check(wide).values())
    assert not Q.wide_schema_check(wide.drop("H24", "H25"))["has_24_hours"]


def test_quality_report_and_balance(spark):
    rows = [(dt.datetime(2022, 6, 14, h), c, None if (h == 1 and c == "PT") else 1.0, h >= 12)
            for h in range(24) for c in ("ES", "PT")]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, price_eur_mwh double, in_policy boolean")
    q = Q.quality_report(df).collect()[0]
    assert q["rows"] == 48 and q["missing_prices"] == 1 and q["rows_during"] == 24 and not q["missing_warning"]
    b = Q.series_balance(df).collect()[0]
    assert b["equal_rows"] and b["aligned"]


def test_duplicate_report(spark):
    rows = [(1, "a", 1.0, "f1"), (1, "a", 2.0, "f2"), (1, "a", 2.0, "f2"), (2, "a", 3.0, "f1")]
    df = spark.createDataFrame(rows, "t int, k string, v double, src string")
    r = Q.duplicate_report(df, ["t", "k"], "v", "src").collect()
    assert len(r) == 1 and r[0]["occurrences"] == 3 and r[0]["n_distinct_values"] == 2 and r[0]["n_sources"] == 2


def test_missing_tables(spark):
    out = {r["table_name"]: r["present"] for r in catalog.missing_tables(
        spark, ["prices_day_ahead", "weather"], ["weather"]).collect()}
    assert out == {"prices_day_ahead": False, "weather": True}


def test_merge_diagnosis(spark):
    left = spark.createDataFrame([("ES", dt.datetime(2022, 1, 1, h)) for h in range(4)], "country string, timestamp timestamp_ntz")
    right = spark.createDataFrame([("ES", dt.datetime(2022, 1, 1, 1))], "country string, timestamp timestamp_ntz")
    d = Q.merge_diagnosis(left, right, ["country", "timestamp"]).collect()[0]
    assert d["left_rows"] == 4 and d["unmatched"] == 3 and d["matched"] == 1 and d["overlap"] == 1
    assert F is not None


def test_top_level_api(spark):
    import wattgrid as W
    idx = W.create_hour_index(spark, "2022-06-15", "2022-06-16")
    assert idx.count() == 48
    feats = W.add_time_features(W.normalize_to_utc(idx))
    assert "is_weekend" in feats.columns
    assert W.get_row_count(feats).collect()[0]["row_count"] == 48
    assert [r["column_name"] for r in W.get_table_info(idx).collect()] == ["timestamp"]
