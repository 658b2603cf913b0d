"""Table schemas (S11) and key lists.

Five fixed tables of the hourly-market data model plus the raw wide price file.
Timestamps are TIMESTAMP_NTZ holding UTC wall time (immune to the session zone).
Spark does not enforce keys or NOT NULL on Parquet, so `KEYS` feeds the dedupe
and expectation operators instead.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TS = T.TimestampNTZType()
D = T.DoubleType()
S = T.StringType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


PRICES_DAY_AHEAD = T.StructType([
    _f("timestamp", TS, False), _f("country", S, False),
    _f("price_eur_mwh", D, False), _f("energy_mwh", D)])

GENERATION = T.StructType([
    _f("timestamp", TS, False), _f("country", S, False),
    _f("technology", S, False), _f("generation_mw", D, False)])

CROSS_BORDER_FLOWS = T.StructType([
    _f("timestamp", TS, False), _f("country_from", S, False),
    _f("country_to", S, False), _f("flow_mw", D, False)])

WEATHER = T.StructType([
    _f("timestamp", TS, False), _f("location", S, False),
    _f("latitude", D, False), _f("longitude", D, False),
    _f("temperature_c", D), _f("wind_speed_10m", D), _f("wind_speed_100m", D),
    _f("wind_direction_100m", D), _f("solar_radiation", D), _f("dni", D),
    _f("diffuse_radiation", D), _f("cloud_cover", D)])

BID_CURVES = T.StructType([
    _f("timestamp", TS, False), _f("country", S, False), _f("generator_id", S),
    _f("price_eur_mwh", D, False), _f("quantity_mw", D, False),
    _f("bid_type", S), _f("technology", S)])

# Raw wide price file: one row per (DATE, CONCEPT), one nullable column per hour.
HOUR_COLUMNS = [f"H{i}" for i in range(1, 26)]
WIDE_PRICES = T.StructType(
    [_f("DATE", T.DateType()), _f("CONCEPT", S)] + [_f(h, D) for h in HOUR_COLUMNS])

TABLES = {
    "prices_day_ahead": PRICES_DAY_AHEAD,
    "generation": GENERATION,
    "cross_border_flows": CROSS_BORDER_FLOWS,
    "weather": WEATHER,
    "bid_curves": BID_CURVES,
}

KEYS = {
    "prices_day_ahead": ["timestamp", "country"],
    "generation": ["timestamp", "country", "technology"],
    "cross_border_flows": ["timestamp", "country_from", "country_to"],
    "weather": ["timestamp", "location"],
    "bid_curves": [],
}

# Wide-file concept codes and the country each one maps to.
CONCEPT_TO_COUNTRY = {"PRICE_SP": "ES", "PRICE_PT": "PT"}


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """An empty DataFrame with the declared schema of ``name``."""
    return spark.createDataFrame([], TABLES[name])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast by *name* against a schema (never positional).

    Columns missing from ``df`` become typed NULLs; extra columns are dropped.
    """
    from pyspark.sql import functions as F
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])
