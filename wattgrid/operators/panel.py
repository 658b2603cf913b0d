"""The gapless hour x series panel (Q-panel: T2 T3 J1 J2 J3 J4 A22 T4 T5).

Plan shape: ``Project(calendar) <- LeftJoin(flows on timestamp)
<- LeftJoin(weather on timestamp, country) <- LeftJoin(prices on timestamp,
country) <- keyed hour spine``. All (timestamp, country) joins share one
hash partitioning, so after the first exchange the later joins reuse it; a side
that AQE measures as small is broadcast at run time instead.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timecols as tc
from ..functions.keys import join_on_keys
from . import timeaxis as tx


def dimension(spark: SparkSession, mapping: dict, key_col: str, value_col: str) -> DataFrame:
    """A small literal dimension table (e.g. city -> country), J4."""
    return spark.createDataFrame([(k, v) for k, v in mapping.items()], f"{key_col} string, {value_col} string")


def weather_by_country(weather: DataFrame, city_dim: DataFrame, value_cols: list[str],
                       timestamp_col: str = "timestamp", location_col: str = "location",
                       country_col: str = "country", weight_col: str | None = None,
                       dim_is_literal: bool = False, unmapped: str | None = None) -> DataFrame:
    """J4 + A22: map cities to countries and average per (hour, country).

    Plain unweighted mean by default (what the reference computes); pass
    ``weight_col`` on the dimension for a weighted mean. The dimension is left to AQE, which
    broadcasts by measured size; ``dim_is_literal`` forces it for one written in code.
    Locations the dimension does not name are left out, or kept under the name ``unmapped``.
    """
    dim = F.broadcast(city_dim) if dim_is_literal else city_dim
    j = weather.join(dim, location_col, "left" if unmapped else "inner")
    if unmapped:
        j = j.withColumn(country_col, F.coalesce(country_col, F.lit(unmapped)))
        if weight_col:
            j = j.withColumn(weight_col, F.coalesce(weight_col, F.lit(1.0)))
    if weight_col is None:
        aggs = [F.avg(c).alias(c) for c in value_cols]
    else:
        w = F.col(weight_col)
        aggs = [F.try_divide(F.sum(F.col(c) * w), F.sum(F.when(F.col(c).isNotNull(), w))).alias(c)
                for c in value_cols]
    return j.groupBy(timestamp_col, country_col).agg(*aggs)


def build_panel(spine: DataFrame, prices: DataFrame, weather: DataFrame | None = None,
                flows_wide: DataFrame | None = None, timestamp_col: str = "timestamp",
                key_col: str = "country", policy: tuple[str, str] | None = tx.DEFAULT_POLICY,
                flag_col: str = "in_policy", features: bool = True) -> DataFrame:
    """Left-join every source onto the keyed spine and add calendar features.

    ``prices`` / ``weather`` must be unique on (timestamp, key) (dedupe first);
    ``flows_wide`` is unique on timestamp and its columns repeat for every key.
    The panel keeps exactly one row per spine row (left joins on unique keys). A NULL key is a key.
    """
    keys = [timestamp_col, key_col]
    p = join_on_keys(spine, prices, keys, "left")
    if weather is not None:
        p = join_on_keys(p, weather, keys, "left")
    if flows_wide is not None:
        p = join_on_keys(p, flows_wide, [timestamp_col], "left")
    if features:
        p = tx.add_time_features(p, timestamp_col, policy, flag_col)
    return p


def country_hour_spine(spark: SparkSession, start_date, end_date, countries: list[str],
                       timestamp_col: str = "timestamp", key_col: str = "country",
                       num_partitions: int | None = None) -> DataFrame:
    """T2 + T3 for explicit parameters: every hour x every listed country.

    Hours come from ``spark.range`` (generated in parallel); each hour row
    expands the literal country list, so no join is involved.
    """
    hours = tx.hour_spine(spark, start_date, end_date, timestamp_col, num_partitions)
    return hours.select(timestamp_col, F.explode(F.array(*[F.lit(c) for c in countries])).alias(key_col))


def build_main_panel(spark: SparkSession, prices: DataFrame, start_date, end_date, countries: list[str],
                     weather: DataFrame | None = None, flows_wide: DataFrame | None = None,
                     policy: tuple[str, str] | None = tx.DEFAULT_POLICY, flag_col: str = "in_policy",
                     timestamp_col: str = "timestamp", key_col: str = "country") -> DataFrame:
    """Q-panel with the reference's parameters ``(start_date, end_date, countries)``.

    Sources are restricted to the range (half-open, pushed to the scan) and to
    the listed countries before the joins; the result has exactly
    hours x countries rows, end date inclusive through 23:00.
    """
    import datetime as _dt
    end_excl = (_dt.date.fromisoformat(str(end_date)[:10]) + _dt.timedelta(days=1)).isoformat()
    rng = tc.time_range(timestamp_col, str(start_date)[:10], end_excl)
    spine = country_hour_spine(spark, start_date, end_date, countries, timestamp_col, key_col)
    p = prices.filter(rng & F.col(key_col).isin(countries))
    w = weather.filter(rng & F.col(key_col).isin(countries)) if weather is not None else None
    f = flows_wide.filter(rng) if flows_wide is not None else None
    return build_panel(spine, p, w, f, timestamp_col, key_col, policy, flag_col)
