"""Aggregations (A1-A23). Every function is one grouped pass unless noted.

NULLs are skipped by every aggregate; NaN must have been turned into NULL at the
scan (``functions.nans_to_nulls``), matching pandas' skip-NaN statistics.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import join_on_keys
from ..functions.numeric import safe_div
from . import series as S


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def series_summary(df: DataFrame, timestamp_col: str = "timestamp",
                   key_col: str = "country") -> DataFrame:
    """A1: rows, first and last timestamp, distinct keys; one pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(key_col).alias("n_keys"),
                  F.min(timestamp_col).alias("start"), F.max(timestamp_col).alias("end"))


def distinct_days(df: DataFrame, timestamp_col: str = "timestamp", group_cols=(),
                  approx: bool = False) -> DataFrame:
    """A2: ``COUNT(DISTINCT day)``; ``approx`` uses HyperLogLog++."""
    return df.groupBy(*group_cols).agg(distinct_days_expr(timestamp_col, approx))


def distinct_days_expr(timestamp_col: str = "timestamp", approx: bool = False) -> Column:
    """A2 as an aggregate expression, to share a grouped pass with others."""
    d = F.to_date(timestamp_col)
    return (F.approx_count_distinct(d) if approx else F.count_distinct(d)).alias("distinct_days")


def null_counts(df: DataFrame, cols: list[str], group_cols=(), extra: list[Column] | None = None) -> DataFrame:
    """A3: per column, number of NULLs (``count_if``), with any ``extra`` aggregates in the same pass."""
    return df.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols], *(extra or []))


def value_stats(value_col, prefix: str = "", which=("n", "mean", "std", "min", "max")) -> list[Column]:
    """A8/A11 building block: aggregate expressions for one value column, each combined map-side.

    The median is not among them (see ``group_stats``): as an aggregate it would hold
    every distinct value of a group in one task.
    """
    v = _c(value_col)
    table = {
        "rows": F.count(F.lit(1)), "n": F.count(v), "mean": F.avg(v),
        "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v), "sum": F.sum(v),
    }
    return [table[w].alias(prefix + w) for w in which]


def group_stats(df: DataFrame, group_cols: list, value_col: str,
                which=("n", "mean", "median", "std", "min", "max"), probs: dict[str, float] | None = None) -> DataFrame:
    """Grouped count, mean, median, sample std, min, max; ``probs`` adds
    named quantiles. Order statistics come from ``quantiles`` and are joined on the group."""
    base = df.groupBy(*group_cols).agg(*value_stats(value_col, "", [w for w in which if w != "median"]))
    named = ({"median": 0.5} if "median" in which else {}) | (probs or {})
    if not named:
        return base
    q = quantiles(df, group_cols, value_col, list(named.values()), list(named))
    if not group_cols:
        return base.withColumn("_g", F.lit(0)).join(q.withColumn("_g", F.lit(0)), "_g", "left").select(*which, *(probs or {}))
    return join_on_keys(base, q, list(group_cols), "left").select(*group_cols, *which, *(probs or {}))


def quantiles(df: DataFrame, group_cols: list, value_col: str, probs: list[float],
              names: list[str] | None = None, approx: bool = False,
              accuracy: int = 10000) -> DataFrame:
    """Exact linear-interpolated quantiles (pandas / DuckDB ``quantile_cont``).

    Values are ranked by ``series.value_ranks`` (two-level prefix sum of value counts) and
    the two ranks around each position are looked up in one aggregate, so a group's
    values never meet in one task. NULLs are skipped; a group of NULLs alone gives no row.
    ``approx=True`` uses ``percentile_approx`` (relative rank error about 1/accuracy).
    """
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    d = df.filter(F.col(value_col).isNotNull())
    if approx:
        q = F.percentile_approx(_c(value_col), F.array(*[F.lit(float(p)) for p in probs]), accuracy)
        out = d.groupBy(*group_cols).agg(q.alias("_q"))
        return out.select(*group_cols, *[F.col("_q")[i].cast("double").alias(n) for i, n in enumerate(names)])
    return rank_lookup(S.value_ranks(d, list(group_cols), value_col), group_cols, probs, names)


def rank_lookup(ranks: DataFrame, group_cols: list, probs: list[float], names: list[str]) -> DataFrame:
    """Interpolated quantiles from ranked values (``_v``, ``rank_first``, ``n_total``), in one aggregate."""
    first, v, aggs = F.col("rank_first"), F.col("_v").cast("double"), []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("n_total") - 1)
        for side, index in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            # the value at an index: the largest whose run starts at or before it
            aggs.append(F.max(F.when(first <= index, v)).alias(f"_{side}{i}"))
    out = ranks.groupBy(*group_cols).agg(F.max("n_total").alias("_n"), *aggs)
    sel = []
    for i, (p, n) in enumerate(zip(probs, names)):
        at = F.lit(float(p)) * (F.col("_n") - 1)
        part = at - F.floor(at)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        sel.append(F.when(part == 0, lo).otherwise(lo + (hi - lo) * part).alias(n))
    return out.select(*group_cols, *sel)


def correlation(df: DataFrame, a: str, b: str, group_cols=()) -> DataFrame:
    """Pearson correlation; pairs with a NULL on either side are skipped."""
    return df.groupBy(*group_cols).agg(F.corr(a, b).alias("correlation"),
                                       F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias("n_pairs"))


def arg_extremes(df: DataFrame, group_cols: list, x_col: str, y_col: str) -> DataFrame:
    """X at the max and at the min of y per group, first (smallest x) on ties.

    NULL y rows are dropped first: a struct ordering would not skip them.
    """
    d = df.filter(F.col(y_col).isNotNull())
    x, y = F.col(x_col), F.col(y_col)
    return d.groupBy(*group_cols).agg(
        F.max_by(F.struct(x, y), F.struct(y, -x))[x_col].alias(f"argmax_{x_col}"),
        F.max(y).alias(f"max_{y_col}"),
        F.min_by(F.struct(x, y), F.struct(y, x))[x_col].alias(f"argmin_{x_col}"),
        F.min(y).alias(f"min_{y_col}"))


def coefficient_of_variation(value_col) -> Column:
    """Sample std / mean, NULL when the mean is 0."""
    return safe_div(F.stddev_samp(_c(value_col)), F.avg(_c(value_col)))


def _with_group(df: DataFrame, group_cols: list) -> tuple[DataFrame, list]:
    """Ungrouped calls get a constant key, so every step is a keyed equi-join."""
    if group_cols:
        return df, list(group_cols)
    return df.withColumn("_g", F.lit(0)), ["_g"]


def histogram(df: DataFrame, group_cols: list, value_col: str, bins: int = 50,
              density: bool = False) -> DataFrame:
    """Equal-width histogram per group between the group's min and max.

    Bin index ``least(floor((x - lo) * bins / (hi - lo)), bins - 1)``, so x = max
    falls in the last bin (``width_bucket`` would put it in bin ``bins + 1``).
    If max = min the range is [x - 0.5, x + 0.5], as numpy does. Empty bins are
    kept (count 0). Pass 1 is a tiny per-group min/max table that the counting
    pass joins back (broadcast by AQE when small, shuffled otherwise).
    """
    d, keys = _with_group(df.filter(F.col(value_col).isNotNull()), group_cols)
    v = F.col(value_col)
    rng = d.groupBy(*keys).agg(F.min(v).alias("_mn"), F.max(v).alias("_mx"), F.count(v).alias("_n"))
    rng = rng.select(*keys, "_n",
                     F.when(F.col("_mx") > F.col("_mn"), F.col("_mn")).otherwise(F.col("_mn") - 0.5).alias("_lo"),
                     F.when(F.col("_mx") > F.col("_mn"), F.col("_mx")).otherwise(F.col("_mx") + 0.5).alias("_hi"))
    keyed = join_on_keys(d.select(*keys, v.alias("_v")), rng, keys)
    idx = F.least(F.floor((F.col("_v") - F.col("_lo")) * F.lit(bins) / (F.col("_hi") - F.col("_lo"))),
                  F.lit(bins - 1)).cast("bigint")
    counts = keyed.groupBy(*keys, idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = rng.select(*keys, "_n", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("_b")) \
        .withColumn("bin", F.col("_b").cast("bigint")).drop("_b")
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    out = join_on_keys(spine, counts, [*keys, "bin"], "left").select(
        *keys, "bin", "_n",
        (F.col("_lo") + F.col("bin") * width).alias("bin_lo"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
        F.coalesce("count", F.lit(0)).alias("count"),
        (F.coalesce("count", F.lit(0)) / (F.col("_n") * width)).alias("density"))
    out = out.drop("_n")
    if not density:
        out = out.drop("density")
    return out.drop("_g") if not group_cols else out


def box_stats(df: DataFrame, group_cols: list, value_col: str, whis: float = 1.5,
              approx: bool = False) -> DataFrame:
    """Box-plot statistics per group.

    Quartiles (linear), IQR, fences at ``whis`` x IQR, whiskers at the most extreme
    value inside the fences, and the count of values outside. Pass 1 computes the
    per-group quartiles (a small table); pass 2 joins them back and takes
    conditional min/max/count in one aggregate.
    """
    d, keys = _with_group(df.filter(F.col(value_col).isNotNull()), group_cols)
    q = quantiles(d, keys, value_col, [0.25, 0.5, 0.75], ["q1", "median", "q3"], approx=approx)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - whis * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + whis * F.col("iqr"))
    # The quartile row rides through the join, so the small quartile table is
    # joined once (no second join that would recompute it).
    qcols = ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence"]
    joined = join_on_keys(d.select(*keys, F.col(value_col).alias("_v")), q, keys)
    inside = (F.col("_v") >= F.col("lo_fence")) & (F.col("_v") <= F.col("hi_fence"))
    out = joined.groupBy(*keys).agg(
        *[F.first(c).alias(c) for c in qcols],
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))
    return out.drop("_g") if not group_cols else out


def mean_by_group(df: DataFrame, group_cols: list, value_cols: list[str],
                  weight_col: str | None = None) -> DataFrame:
    """Plain (or weighted) mean of several columns per group."""
    if weight_col is None:
        return df.groupBy(*group_cols).agg(*[F.avg(c).alias(c) for c in value_cols])
    w = F.col(weight_col)
    return df.groupBy(*group_cols).agg(*[
        safe_div(F.sum(F.col(c) * w), F.sum(F.when(F.col(c).isNotNull(), w))).alias(c) for c in value_cols])


def circular_mean_deg(col) -> Column:
    """Mean direction in degrees [0, 360) for wind directions (Q12)."""
    r = F.radians(_c(col))
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(r)), F.avg(F.cos(r)))), F.lit(360.0))


STILL = 1e-6  # steadiness below which directions cancel and have no mean


def circular_by_group(df: DataFrame, group_cols: list, value_col: str, weight_col: str | None = None) -> DataFrame:
    """Q12: mean direction per group as a vector mean, optionally weighted; one pass.

    ``direction`` in degrees [0, 360); ``steadiness`` is the mean vector's length, from 0 (directions
    cancel) to 1 (all equal); ``n`` counts the values. Missing and infinite values, and weights that
    are missing or not above zero, are left out. Where directions cancel, ``direction`` is NULL.
    """
    v = F.col(value_col).cast("double")
    w = F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")
    used = ~F.isnan(v) & (F.abs(v) < float("inf")) & (w > 0) & (w < float("inf"))
    a = F.radians(v)
    sums = df.groupBy(*group_cols).agg(F.sum(F.when(used, w * F.sin(a))).alias("_s"), F.sum(F.when(used, w * F.cos(a))).alias("_c"),
                                       F.sum(F.when(used, w)).alias("_w"), F.count_if(used).alias("n"))
    sums = sums.withColumn("steadiness", safe_div(F.sqrt(F.col("_s") * F.col("_s") + F.col("_c") * F.col("_c")), F.col("_w")))
    deg = F.degrees(F.atan2("_s", "_c"))
    deg = F.when(deg < 0, deg + 360.0).otherwise(deg)
    deg = F.when(deg >= 360.0 - 1e-9, F.lit(0.0)).otherwise(deg)  # a hair below north is north
    return sums.select(*group_cols, F.when(F.col("steadiness") >= STILL, deg).alias("direction"), "steadiness", "n")
