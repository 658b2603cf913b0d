"""Small inputs from FIXTURES.md (F1-F11), built as DataFrames."""
import datetime as dt


def ts(s):
    return dt.datetime.fromisoformat(s)


def hourly(spark, start, n, value_fn=lambda i: float(i), col="value"):
    t0 = ts(start)
    rows = [(t0 + dt.timedelta(hours=i), value_fn(i)) for i in range(n)]
    return spark.createDataFrame(rows, f"timestamp timestamp_ntz, {col} double")


def f9_prices(spark):
    t0 = ts("2022-06-15 00:00:00")
    rows = []
    for c, base in (("ES", 100.0), ("PT", 105.0)):
        for i in range(48):
            rows.append((t0 + dt.timedelta(hours=i), c, base + i, 25000.0 + 100 * i))
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, price_eur_mwh double, energy_mwh double")


def f10_weather(spark):
    t0 = ts("2022-06-15 00:00:00")
    rows = [(t0 + dt.timedelta(hours=i), "ES", 20 + 0.5 * i, 10 + 0.2 * i) for i in range(48)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, country string, temperature_c double, "
                                       "wind_speed_100m double")


def collect_sorted(df, *cols):
    return [r.asDict() for r in df.orderBy(*cols).collect()]


def col_values(df, c, order):
    return [r[c] for r in df.orderBy(*order).select(c, *order).collect()]


__all__ = ["ts", "hourly", "f9_prices", "f10_weather", "collect_sorted", "col_values"]
