"""Reshape operators (R1-R6): wide <-> long, pivots, side-by-side summaries."""
from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import is_missing

_HOUR_COL = re.compile(r"^H(\d+)$")


def hour_columns(df: DataFrame, include_h25: bool = False) -> list[str]:
    """Columns named ``H`` + digits, in hour order (H25 only on request)."""
    cols = [(int(m.group(1)), c) for c in df.columns if (m := _HOUR_COL.match(c))]
    return [c for n, c in sorted(cols) if include_h25 or n <= 24]


def wide_to_long(df: DataFrame, id_cols: list[str], value_cols: list[str] | None = None,
                 hour_index_col: str = "hour_index", value_col: str = "value",
                 include_h25: bool = False, drop_missing: bool = True) -> DataFrame:
    """``H1..H24`` columns to rows with a 0-based hour index.

    ``unpivot`` keeps NULL and NaN cells, so missing values are dropped
    explicitly (P4) unless ``drop_missing`` is False.
    """
    value_cols = value_cols or hour_columns(df, include_h25)
    long = df.unpivot(id_cols, value_cols, "_hcol", value_col)
    long = long.withColumn(hour_index_col,
                           F.regexp_extract("_hcol", r"(\d+)", 1).cast("int") - 1).drop("_hcol")
    if drop_missing:
        long = long.filter(~is_missing(value_col))
    return long


def long_to_wide(df: DataFrame, index_cols: list[str], pivot_cols: list[str], values: list,
                 value_col: str, agg: str = "sum", name_fmt: str | None = None,
                 other: str | None = None) -> DataFrame:
    """One column per pivot value, from an explicit value list.

    An explicit list avoids the extra distinct job a bare ``pivot`` runs, and
    keeps the output schema stable. ``pivot_cols`` may be several columns (e.g.
    from/to); each entry of ``values`` is then a tuple. ``name_fmt`` formats the
    output column name from the value(s), e.g. ``"{0}_to_{1}_mw"``. ``other`` names
    a column for everything that is not listed (NULLs too), so no row is lost.
    """
    fn = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "max": F.max, "min": F.min, "first": F.first}[agg]
    multi = len(pivot_cols) > 1
    tuples = [tuple(v) if multi else (v,) for v in values]
    fmt = name_fmt or "_".join("{%d}" % i for i in range(len(pivot_cols)))
    # Conditional aggregation == pivot with an explicit list; one hash aggregate.
    exprs = []
    for t in tuples:
        cond = F.lit(True)
        for c, v in zip(pivot_cols, t):
            cond = cond & (F.col(c) == F.lit(v))
        exprs.append(fn(F.when(cond, F.col(value_col))).alias(fmt.format(*t)))
    if other:
        listed = F.struct(*[F.col(c) for c in pivot_cols]).isin([F.struct(*[F.lit(v) for v in t]) for t in tuples]) if multi else F.col(pivot_cols[0]).isin(list(values))
        exprs.append(fn(F.when(~F.coalesce(listed, F.lit(False)), F.col(value_col))).alias(other))
    return df.groupBy(*index_cols).agg(*exprs)


def pivot_matrix(df: DataFrame, row_col: str, pivot_col: str, values: list, value_col: str,
                 agg: str = "avg", other: str | None = None) -> DataFrame:
    """E.g. year x country matrix of means, one column per listed value; ``other`` as in
    ``long_to_wide``."""
    return long_to_wide(df, [row_col], [pivot_col], values, value_col, agg, "{0}", other)


DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def describe_long(df: DataFrame, key_col: str, value_col: str) -> DataFrame:
    """A13 in long form: (key, stat, value) for the eight ``describe`` statistics.

    Exact linear-interpolated quartiles (``stats.quantiles``), sample std; NULLs skipped.
    """
    from .stats import group_stats  # stats builds on series; reshape is below both
    agg = group_stats(df, [key_col], value_col, ("n", "mean", "std", "min", "max"), {"25%": 0.25, "50%": 0.5, "75%": 0.75})
    agg = agg.select(key_col, F.col("n").cast("double").alias("count"), "mean", "std", F.col("min").cast("double").alias("min"),
                     "`25%`", "`50%`", "`75%`", F.col("max").cast("double").alias("max"))
    return agg.unpivot([key_col], DESCRIBE_STATS, "stat", "value")


def describe_side_by_side(df: DataFrame, key_col: str, value_col: str, keys: list[str],
                          names: list[str] | None = None) -> DataFrame:
    """``describe()`` of several series as side-by-side columns, 8 rows."""
    names = names or keys
    long = describe_long(df.filter(F.col(key_col).isin(keys)), key_col, value_col)
    order = F.create_map(*[x for i, s in enumerate(DESCRIBE_STATS) for x in (F.lit(s), F.lit(i))])
    wide = long.groupBy("stat").agg(*[
        F.max(F.when(F.col(key_col) == F.lit(k), F.col("value"))).alias(n)
        for k, n in zip(keys, names)])
    return wide.withColumn("stat_order", order[F.col("stat")].cast("bigint"))


def hourly_side_by_side(df: DataFrame, key_col: str, value_col: str, keys: list[str],
                        names: list[str] | None = None, hour_col: str = "hour") -> DataFrame:
    """``hour, <a>_avg, <b>_avg, <a>_std, <b>_std`` for hours 0..23.

    One grouped pass with conditional aggregates, then a 24-row hour spine so a
    missing hour gives NULLs instead of an error.
    """
    names = names or keys
    v = F.col(value_col)
    sel = df.filter(F.col(key_col).isin(keys))
    aggs = [F.avg(F.when(F.col(key_col) == F.lit(k), v)).alias(f"{n}_avg") for k, n in zip(keys, names)]
    aggs += [F.stddev_samp(F.when(F.col(key_col) == F.lit(k), v)).alias(f"{n}_std") for k, n in zip(keys, names)]
    grouped = sel.groupBy(F.col(hour_col).cast("int").alias("hour")).agg(*aggs)
    spark = df.sparkSession
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    return hours.join(grouped, "hour", "left")
