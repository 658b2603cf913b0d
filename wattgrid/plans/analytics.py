"""Composite analytics over an hourly panel.

Every function is ``DataFrame -> DataFrame``, lazy, with no collect inside.
Column names are parameters; defaults follow the panel schema
(``timestamp, country, price_eur_mwh, hour, is_weekend, in_policy``).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timecols as tc
from ..functions.keys import join_on_keys
from ..functions.numeric import combine_single_rows, safe_div
from ..operators import joins as J
from ..operators import series as S
from ..operators import stats as A
from ..operators import timeaxis as tx

TS, KEY, PRICE, FLAG = "timestamp", "country", "price_eur_mwh", "in_policy"

# Coupling labels and their correlation thresholds.
COUPLING_LABELS = [(0.95, "Strongly coupled market"), (0.80, "Moderately coupled market")]
COUPLING_DEFAULT = "Weakly coupled market"
IDENTICAL_EPS = 0.01


def policy_impact(panel: DataFrame, key: str = KEY, value: str = PRICE, flag: str = FLAG,
                  ts: str = TS) -> DataFrame:
    """Q-impact: per series, pre vs during statistics and the effect.

    "pre" is "not during" (flag false, Q15). ``savings`` = |mean_diff| x all
    rows during (NULL prices included, Q14) when prices fell.
    """
    v, f = F.col(value), F.col(flag)
    aggs = []
    for name, cond in (("pre", ~f), ("during", f)):
        x = F.when(cond, v)
        aggs += [F.count_if(cond).alias(f"rows_{name}"), F.count(x).alias(f"n_{name}"),
                 F.avg(x).alias(f"mean_{name}"),
                 F.stddev_samp(x).alias(f"std_{name}"), F.min(x).alias(f"min_{name}"),
                 F.max(x).alias(f"max_{name}"),
                 F.to_date(F.min(F.when(cond, F.col(ts)))).alias(f"first_{name}"),
                 F.to_date(F.max(F.when(cond, F.col(ts)))).alias(f"last_{name}")]
    out = panel.groupBy(key).agg(*aggs)
    q = A.quantiles(panel.filter(f.isNotNull()), [key, flag], value, [0.5], ["_med"])
    q = q.groupBy(key).agg(F.max(F.when(~f, F.col("_med"))).alias("median_pre"), F.max(F.when(f, F.col("_med"))).alias("median_during"))
    out = join_on_keys(out, q, [key], "left")
    diff = F.col("mean_during") - F.col("mean_pre")
    return out.withColumns({
        "mean_diff": diff,
        "pct_change": safe_div(diff, F.col("mean_pre")) * 100,
        "direction": F.when(diff < 0, F.lit("decrease")).when(diff >= 0, F.lit("increase")),
        "savings": F.when(diff < 0, F.abs(diff) * F.col("rows_during")),
    })


def phase_stats(panel: DataFrame, phase_col: str = "phase", key: str = KEY, value: str = PRICE,
                probs=(0.1, 0.9)) -> DataFrame:
    """Q-stats5: mean, median, std, P10, P90 (plus rows, n, min, max) per series and phase."""
    names = {f"p{int(round(p * 100)):02d}": p for p in probs}
    return A.group_stats(panel, [key, phase_col], value, ("rows", "n", "mean", "median", "std", "min", "max"), names)


def coupling(panel: DataFrame, a: str, b: str, key: str = KEY, value: str = PRICE, ts: str = TS,
             eps: float = IDENTICAL_EPS) -> DataFrame:
    """Q-coupling + Q-couple-label: one row for a pair of series aligned on time."""
    pair = J.align_pair(panel, ts, key, value, a, b, "_a", "_b")
    d = F.col("_a") - F.col("_b")
    out = pair.agg(F.count(F.lit(1)).alias("n_hours"),
                   F.count(d).alias("n_pairs"),
                   F.corr("_a", "_b").alias("correlation"),
                   F.avg(d).alias("mean_diff"), F.max(F.abs(d)).alias("max_abs_diff"),
                   F.count_if(F.abs(d) < eps).alias("identical_hours"))
    share = safe_div(F.col("identical_hours").cast("double"), F.col("n_hours").cast("double"))
    label = F.lit(COUPLING_DEFAULT)
    for thr, name in reversed(COUPLING_LABELS):
        label = F.when(F.col("correlation") > thr, F.lit(name)).otherwise(label)
    return out.withColumns({"identical_share": share, "highly_coupled": share > 0.95,
                            "coupling_label": label})


def divergence(panel: DataFrame, a: str, b: str, key: str = KEY, value: str = PRICE, ts: str = TS,
               eps: float = IDENTICAL_EPS) -> DataFrame:
    """Q-split: when the two prices diverge (|diff| >= eps), by month and hour."""
    pair = J.align_pair(panel, ts, key, value, a, b, "_a", "_b")
    d = F.abs(F.col("_a") - F.col("_b"))
    return pair.groupBy(tc.trunc_month(ts).alias("month"), F.hour(ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("n_hours"), F.count(d).alias("n_both"),
        F.count_if(d >= eps).alias("n_diverged")) \
        .withColumn("share_diverged", safe_div(F.col("n_diverged").cast("double"), F.col("n_both").cast("double")))


def hourly_profile(panel: DataFrame, key: str = KEY, value: str = PRICE, hour: str = "hour",
                   extra_keys=()) -> DataFrame:
    """Q-hourly / A8 / W9: mean and sample std per hour with the +/- std band."""
    v = F.col(value)
    out = panel.groupBy(key, *extra_keys, hour).agg(F.count(v).alias("n"), F.avg(v).alias("mean"),
                                                    F.stddev_samp(v).alias("std"))
    return out.withColumns({"band_lo": F.col("mean") - F.col("std"), "band_hi": F.col("mean") + F.col("std")})


def peak_trough(profile: DataFrame, key: str = KEY, hour: str = "hour", mean: str = "mean") -> DataFrame:
    """Q-hourly / A15 / O4: peak and trough hour of the hourly mean, first on ties."""
    e = A.arg_extremes(profile, [key], hour, mean)
    return e.select(key, F.col(f"argmax_{hour}").alias("peak_hour"), F.col(f"max_{mean}").alias("peak_mean"),
                    F.col(f"argmin_{hour}").alias("trough_hour"), F.col(f"min_{mean}").alias("trough_mean"),
                    (F.col(f"max_{mean}") - F.col(f"min_{mean}")).alias("spread"))


def daytype_stats(panel: DataFrame, key: str = KEY, value: str = PRICE, weekend: str = "is_weekend") -> DataFrame:
    """Q-daytype: mean, std, min, max per series and day type (P10 labels)."""
    return panel.withColumn("day_type", tc.day_type(weekend)).filter(F.col("day_type").isNotNull()) \
        .groupBy(key, "day_type").agg(*A.value_stats(value, which=("n", "mean", "std", "min", "max")))


def daytype_difference(panel: DataFrame, key: str = KEY, value: str = PRICE,
                       weekend: str = "is_weekend") -> DataFrame:
    """Q-daytype: weekday - weekend mean, and as % of the weekday mean."""
    v, w = F.col(value), F.col(weekend)
    out = panel.groupBy(key).agg(F.avg(F.when(~w, v)).alias("weekday_mean"),
                                 F.avg(F.when(w, v)).alias("weekend_mean"))
    d = F.col("weekday_mean") - F.col("weekend_mean")
    return out.withColumns({"difference": d, "pct_difference": safe_div(d, F.col("weekday_mean")) * 100})


def volatility(panel: DataFrame, key: str = KEY, value: str = PRICE, ts: str = TS,
               window: int = 24, bucket_hours: int = S.DEFAULT_BUCKET_HOURS) -> DataFrame:
    """Q-vol: rolling std summary, mean absolute change, largest rise / fall, CV."""
    r = S.rolling_stats(panel.select(key, ts, value), [key], ts, value, window, True,
                        bucket_hours=bucket_hours)
    ch = S.changes(r, [key], ts, value, True, bucket_hours)
    v = F.col(value)
    return ch.groupBy(key).agg(
        F.avg("rolling_std").alias("mean_rolling_std"), F.max("rolling_std").alias("max_rolling_std"),
        F.avg(F.abs(F.col("diff"))).alias("mean_abs_change"),
        F.max("diff").alias("largest_rise"), F.min("diff").alias("largest_fall"),
        F.stddev_samp(v).alias("std"), A.coefficient_of_variation(v).alias("cv"))


def monthly_profile(panel: DataFrame, key: str = KEY, value: str = PRICE, ts: str = TS,
                    flag: str = FLAG) -> DataFrame:
    """Q-monthly / T11: month mean labelled by start and end, with the share of
    policy hours (Q11: a month-end label alone hides a partial month)."""
    return tx.resample(panel, [key], ts, value, "month", ("mean",),
                       extra={"policy_share": F.avg(F.col(flag).cast("double")), "rows": F.count(F.lit(1))})


def diff_in_diff(panel: DataFrame, treated: str, control: str, start: str, key: str = KEY,
                 value: str = PRICE, ts: str = TS) -> DataFrame:
    """Q-did: 2 x 2 difference in differences of means around ``start``."""
    v, k = F.col(value), F.col(key)
    post = F.col(ts) >= tc.ntz(start)
    cells = {"treated_pre": (k == treated) & ~post, "treated_post": (k == treated) & post,
             "control_pre": (k == control) & ~post, "control_post": (k == control) & post}
    out = panel.filter(k.isin(treated, control)).agg(*[F.avg(F.when(c, v)).alias(n) for n, c in cells.items()])
    return out.withColumn("did", (F.col("treated_post") - F.col("treated_pre"))
                          - (F.col("control_post") - F.col("control_pre")))


def supply_curve(bids: DataFrame, group_cols: list[str], price: str = "price_eur_mwh",
                 quantity: str = "quantity_mw") -> DataFrame:
    """Q-curve: stepwise cumulative quantity by ascending price per group.

    Bids are first summed per price level (partial aggregation), then the
    running sum over price levels is an exact two-level prefix sum
    (``series.prefix_sum``), so an hour holding a large share of all bids is not
    sorted in one task. Bids without a price come last; NULL group keys are kept.
    """
    lv = bids.groupBy(*group_cols, price).agg(F.sum(quantity).alias("quantity"),
                                              F.count(F.lit(1)).alias("n_bids"))
    cum = S.prefix_sum(lv, group_cols, price, "quantity", out_col="_before")
    return cum.withColumn("cum_quantity", F.col("_before") + F.coalesce("quantity", F.lit(0))).drop("_before")


def market_clearing(bids: DataFrame, group_cols: list[str], side: str, price: str = "price_eur_mwh", quantity: str = "quantity_mw",
                    supply: str = "supply", demand: str = "demand") -> DataFrame:
    """Q-curve: where the supply curve meets the demand curve, per group (an hour, say).

    Supply up to a price is the quantity offered at it or below, demand the quantity asked at it or
    above. The clearing price is the lowest price level with at least as much supply as
    demand, the quantity the smaller of the two there; both are NULL where nothing can trade. Bids are
    summed per price level first, and both running sums are two-level prefix sums, so no window holds a group
    and an hour with a third of all bids is spread over its price bands. Bids without price, quantity or
    side do not count; a group without any bid that counts has no row.
    """
    def of(which: str):
        return F.sum(F.when(F.col(side) == which, F.col(quantity)).otherwise(0.0))
    ok = bids.filter(F.col(price).isNotNull() & ~F.isnan(price) & F.col(quantity).isNotNull() & F.col(side).isin(supply, demand))
    levels = ok.groupBy(*group_cols, F.col(price).alias("_p")).agg(of(supply).alias("_s"), of(demand).alias("_d"))
    both = S.prefix_sum(levels, group_cols, "_p", "_s", out_col="_s0", total_col="_st")
    both = S.prefix_sum(both, group_cols, "_p", "_d", out_col="_d0", total_col="_dt")
    offered, asked = F.col("_s0") + F.col("_s"), F.col("_dt") - F.col("_d0")
    meet = F.when(offered >= asked, F.col("_p"))
    first = both.withColumns({"_q": F.least(offered, asked), "_meet": meet}).groupBy(*group_cols).agg(
        F.min("_meet").alias("_price"), F.min_by("_q", "_meet").alias("_q"), F.max("_st").alias("supply_total"), F.max("_dt").alias("demand_total"))
    trades = F.col("_q") > 0
    return first.select(*group_cols, F.when(trades, F.col("_price")).alias("clearing_price"), F.when(trades, F.col("_q")).alias("clearing_quantity"),
                        "supply_total", "demand_total")


def shares(df: DataFrame, group_cols: list[str], part_col: str, value_col: str) -> DataFrame:
    """Q-gen: value per part and its share of the group total."""
    parts = df.groupBy(*group_cols, part_col).agg(F.sum(value_col).alias("total"))
    tot = parts.groupBy(*group_cols).agg(F.sum("total").alias("group_total"))
    return join_on_keys(parts, tot, group_cols).withColumn(
        "share", safe_div(F.col("total"), F.col("group_total"))).drop("group_total")


def findings(panel: DataFrame, a: str, b: str, key: str = KEY, value: str = PRICE, ts: str = TS,
             hour: str = "hour", weekend: str = "is_weekend",
             bucket_hours: int = S.DEFAULT_BUCKET_HOURS) -> DataFrame:
    """Q-findings: one-row record of the headline facts for series ``a`` (vs ``b``).

    Price levels, coupling, hourly pattern, weekday vs weekend and volatility,
    each computed by its own operator and joined as single rows.
    """
    k, v, w = F.col(key), F.col(value), F.col(weekend)
    va = F.when(k == a, v)
    levels = panel.filter(k.isin(a, b)).agg(
        F.avg(va).alias("mean_a"), F.avg(F.when(k == b, v)).alias("mean_b"),
        F.min(va).alias("min_a"), F.max(va).alias("max_a"), F.stddev_samp(va).alias("std_a"),
        A.coefficient_of_variation(va).alias("cv_a"),
        F.avg(F.when((k == a) & ~w, v)).alias("weekday_mean_a"),
        F.avg(F.when((k == a) & w, v)).alias("weekend_mean_a"))
    gap = F.abs(F.col("weekday_mean_a") - F.col("weekend_mean_a"))
    levels = levels.withColumns({"daytype_abs_diff": gap,
                                 "daytype_pct_diff": safe_div(gap, F.col("weekday_mean_a")) * 100})
    coup = coupling(panel, a, b, key, value, ts).select("correlation", "coupling_label")
    sa = panel.filter(k == a)
    peak = peak_trough(hourly_profile(sa, key, value, hour), key, hour).select("peak_hour", "trough_hour", "spread")
    ch = S.changes(sa.select(key, ts, value), [key], ts, value, True, bucket_hours) \
        .agg(F.avg(F.abs(F.col("diff"))).alias("mean_abs_change_a"))
    return combine_single_rows([levels, coup, peak, ch])
