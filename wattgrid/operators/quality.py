"""Data-quality reports and expectations (2.14, Q-quality, Q-dups, Q-merge-diag)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timecols as tc
from ..functions.numeric import safe_div


def expectations(df: DataFrame, rules: dict[str, Column], max_fail_rate: dict | None = None) -> DataFrame:
    """One aggregate pass over ``df`` evaluating boolean rules.

    A rule is checked on rows where it is not NULL. Output, one row per rule:
    ``rule, checked, failed, rate, passed`` (``passed`` when ``rate`` is at most
    the rule's allowed failure rate, default 0).
    """
    max_fail_rate = max_fail_rate or {}
    aggs = []
    for name, pred in rules.items():
        aggs.append(F.count(pred).alias(f"{name}__checked"))
        aggs.append(F.count_if(~pred).alias(f"{name}__failed"))
    wide = df.agg(*aggs)
    stack = F.explode(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(f"{n}__checked").alias("checked"),
                 F.col(f"{n}__failed").alias("failed"),
                 F.lit(float(max_fail_rate.get(n, 0.0))).alias("allowed"))
        for n in rules]))
    out = wide.select(stack.alias("r")).select("r.*")
    rate = safe_div(F.col("failed").cast("double"), F.col("checked").cast("double"))
    return out.select("rule", "checked", "failed", rate.alias("rate"),
                      (F.coalesce(rate, F.lit(0.0)) <= F.col("allowed")).alias("passed"))


def panel_rules(price_col: str = "price_eur_mwh", key_col: str = "country",
                lo: float = 0.0, hi: float = 1000.0) -> dict[str, Column]:
    """E1/E7/E8 as row rules (price range, missing price, keys present)."""
    p = F.col(price_col)
    return {
        "price_in_range": F.when(p.isNotNull(), (p >= lo) & (p < hi)),
        "price_present": p.isNotNull(),
        "timestamp_not_null": F.col("timestamp").isNotNull(),
        "key_not_null": F.col(key_col).isNotNull(),
    }


def key_rules(timestamp_col: str = "timestamp", code_col: str = "country", required: tuple[str, ...] = ()) -> dict[str, Column]:
    """Two-letter upper-case codes, whole hours, and columns that may not be NULL."""
    return {"code_format": F.col(code_col).rlike("^[A-Z]{2}$"),
            "whole_hour": F.col(timestamp_col) == tc.trunc_hour(timestamp_col),
            **{f"{c}_not_null": F.col(c).isNotNull() for c in required}}


def wide_price_rules(price_col: str = "price_eur_mwh", lo: float = -500.0, hi: float = 5000.0) -> dict[str, Column]:
    """E1, the wider band: negative prices and scarcity prices are possible, others are errors."""
    p = F.col(price_col)
    return {"price_possible": F.when(p.isNotNull(), (p >= lo) & (p <= hi))}


def mean_bounds(df: DataFrame, bounds: dict[str, tuple[float, float]], group_cols: list[str]) -> DataFrame:
    """E2 on means: per group and column the mean, and whether it lies within its bounds
    (open below, open above); a group without values is not judged (NULL)."""
    means = df.groupBy(*group_cols).agg(*[F.avg(c).alias(c) for c in bounds])
    rows = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("mean"), ((F.col(c) > lo) & (F.col(c) < hi)).alias("within")) for c, (lo, hi) in bounds.items()])
    return means.select(*group_cols, F.explode(rows).alias("r")).select(*group_cols, "r.*")


def weather_rules() -> dict[str, Column]:
    """Plausible ranges for weather columns (NULLs are not checked)."""
    def rng(c, lo, hi, hi_inclusive=False):
        x = F.col(c)
        upper = (x <= hi) if hi_inclusive else (x < hi)
        return F.when(x.isNotNull(), (x > lo) & upper if c == "temperature_c" else (x >= lo) & upper)
    return {"temperature_in_range": rng("temperature_c", -20, 50),
            "wind_in_range": rng("wind_speed_100m", 0, 50),
            "radiation_in_range": rng("solar_radiation", 0, 1500, True)}


def wide_schema_check(df: DataFrame) -> dict[str, bool]:
    """A wide price file has DATE, CONCEPT and at least 24 hour columns.

    A schema-level check (metadata only, no job).
    """
    from .reshape import hour_columns
    cols = set(df.columns)
    return {"has_date": "DATE" in cols, "has_concept": "CONCEPT" in cols,
            "has_24_hours": len(hour_columns(df, include_h25=True)) >= 24}


def handle_dst_transitions(df: DataFrame, keys: list[str], timestamp_col: str = "timestamp",
                           order_cols: list[str] | None = None, threshold_hours: float = 1.5) -> dict[str, DataFrame]:
    """Check and clean hourly series around clock changes.

    Returns three lazy DataFrames: ``gaps`` (steps over ``threshold_hours``),
    ``duplicates`` (every row of a repeated (key, timestamp)) and ``clean``
    (first row kept per (key, timestamp) by ``order_cols``). Keys are per series,
    so a multi-country panel keeps one row per country and hour (Q8).
    """
    from . import dedupe as D
    from . import series as S
    k = [*keys, timestamp_col]
    order = order_cols or [c for c in df.columns if c not in k]
    return {"gaps": S.gaps(df, keys, timestamp_col, threshold_hours),
            "duplicates": D.duplicated_rows(df, k),
            "clean": D.keep_first(df, k, order)}


def quality_report(panel: DataFrame, price_col: str = "price_eur_mwh", key_col: str = "country",
                   flag_col: str = "in_policy", timestamp_col: str = "timestamp") -> DataFrame:
    """Q-quality: one row: rows, range, series, missing prices and rate, phase counts."""
    p = F.col(price_col)
    out = panel.agg(
        F.count(F.lit(1)).alias("rows"), F.min(timestamp_col).alias("start"),
        F.max(timestamp_col).alias("end"), F.count_distinct(key_col).alias("n_series"),
        F.count_if(p.isNull()).alias("missing_prices"),
        F.count_if(F.col(flag_col)).alias("rows_during"),
        F.count_if(~F.col(flag_col)).alias("rows_pre"),
        F.bool_or(p.isNull()).alias("any_missing"),
        F.max(F.when(F.col(flag_col), p)).alias("max_price_during"))
    return out.withColumn("missing_rate", safe_div(F.col("missing_prices").cast("double"),
                                                   F.col("rows").cast("double"))) \
              .withColumn("missing_warning", F.col("missing_rate") > 0.3)


def series_balance(panel: DataFrame, key_col: str = "country", timestamp_col: str = "timestamp") -> DataFrame:
    """Rows per series and whether all series have the same count and range."""
    per = panel.groupBy(key_col).agg(F.count(F.lit(1)).alias("rows"),
                                     F.min(timestamp_col).alias("start"), F.max(timestamp_col).alias("end"))
    return per.agg(F.count(F.lit(1)).alias("n_series"), F.min("rows").alias("min_rows"),
                   F.max("rows").alias("max_rows"),
                   (F.min("rows") == F.max("rows")).alias("equal_rows"),
                   ((F.min("start") == F.max("start")) & (F.min("end") == F.max("end"))).alias("aligned"))


def duplicate_report(df: DataFrame, keys: list[str], value_col: str,
                     source_col: str | None = None) -> DataFrame:
    """Q-dups: per duplicated key: occurrences, sources, distinct values, range.

    Aggregates only (no per-key lists), so a key holding a third of the rows is
    combined map-side like any other.
    """
    aggs = [F.count(F.lit(1)).alias("occurrences"),
            F.count_distinct(value_col).alias("n_distinct_values"),
            F.min(value_col).alias("min_value"), F.max(value_col).alias("max_value")]
    if source_col:
        aggs.append(F.count_distinct(source_col).alias("n_sources"))
    return df.groupBy(*keys).agg(*aggs).filter(F.col("occurrences") > 1)


def merge_diagnosis(left: DataFrame, right: DataFrame, keys: list[str],
                    timestamp_col: str = "timestamp") -> DataFrame:
    """Q-merge-diag: left rows with and without a right match, key overlap.

    One row: left rows, matched, unmatched (by key, J7), distinct timestamps on each
    side and their intersection (U2). Each input is read once: both are counted by
    key, then by timestamp, then summed to a row. NULL keys match NULL keys; a NULL
    timestamp counts as one.
    """
    side = left.select(*keys, F.lit(1).alias("_l")).unionByName(right.select(*keys, F.lit(0).alias("_l")))
    by_key = side.groupBy(*keys).agg(F.sum("_l").alias("_n"), F.min("_l").alias("_right"))  # _right = 0: a right row is there
    by_time = by_key.groupBy(timestamp_col).agg(
        F.sum("_n").alias("_n"), F.sum(F.when(F.col("_right") == 1, F.col("_n")).otherwise(0)).alias("_alone"),
        F.max(F.col("_n") > 0).alias("_l"), F.min("_right").alias("_r"))
    right_too = F.col("_r") == 0
    return by_time.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("left_rows"), F.coalesce(F.sum("_alone"), F.lit(0)).alias("unmatched"),
        F.count_if(F.col("_l")).alias("left_timestamps"), F.count_if(right_too).alias("right_timestamps"),
        F.count_if(F.col("_l") & right_too).alias("overlap")) \
        .withColumn("matched", F.col("left_rows") - F.col("unmatched"))
