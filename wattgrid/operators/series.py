"""Per-series window operators (W1-W6, W9) in bucketed, skew-safe form.

A series key (e.g. country) has very few values, so ``Window.partitionBy(key)``
would put a whole series in one task. Every operator here partitions by
``(key, time bucket)`` instead and stays exact:

* bounded frames (rolling statistics) copy a *halo* of neighbouring hours into
  each bucket, compute, and keep only the bucket's own rows;
* unbounded look-backs (lag across a bucket edge, forward fill, previous
  observed timestamp) use a small per-bucket summary table, a window over that
  table (one row per bucket), and a join back.

Time is measured in whole hours (``hour_number``). Rolling frames are RANGE
frames in hours, which equal pandas' row frames on a gapless hourly spine.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import timecols as tc
from ..functions.keys import join_on_keys
from ..functions.numeric import safe_div

DEFAULT_BUCKET_HOURS = 24 * 7


def _bucket(hour_col: Column, bucket_hours: int) -> Column:
    return F.floor(hour_col / F.lit(bucket_hours)).cast("bigint")


# ---------------------------------------------------------------------------
# Centred rolling mean and std with a halo
# ---------------------------------------------------------------------------

def rolling_stats(df: DataFrame, keys: list[str], timestamp_col: str, value_col: str,
                  window: int = 24, center: bool = True, min_periods: int | None = None,
                  bucket_hours: int = DEFAULT_BUCKET_HOURS, prefix: str = "rolling_") -> DataFrame:
    """Pandas ``rolling(window, center=center)`` mean and sample std.

    The centred even window is asymmetric: ``window // 2`` hours back and
    ``window - 1 - window // 2`` ahead (12 back, 11 ahead for 24). A value is
    NULL unless the frame holds ``min_periods`` (default ``window``) non-null
    values, as in pandas. Adds ``<prefix>mean``, ``<prefix>std`` and the band
    ``<prefix>lo`` / ``<prefix>hi`` = mean -/+ std (W9).
    """
    back = window // 2 if center else window - 1
    ahead = window - 1 - back
    min_periods = window if min_periods is None else min_periods
    bucket_hours = max(bucket_hours, window)
    hn = tc.hour_number(timestamp_col)
    base = df.withColumn("_hn", hn).withColumn("_home", _bucket(F.col("_hn"), bucket_hours))
    # Each row is needed by home rows within [h - ahead, h + back].
    copies = base.withColumn("_b", F.explode(F.sequence(_bucket(F.col("_hn") - ahead, bucket_hours),
                                                         _bucket(F.col("_hn") + back, bucket_hours))))
    w = Window.partitionBy(*keys, "_b").orderBy("_hn").rangeBetween(-back, ahead)
    v = F.col(value_col)
    cnt = F.count(v).over(w)
    mean = F.when(cnt >= min_periods, F.avg(v).over(w))
    std = F.when(cnt >= min_periods, F.stddev_samp(v).over(w))
    out = copies.withColumns({prefix + "mean": mean, prefix + "std": std}) \
        .filter(F.col("_b") == F.col("_home")).drop("_hn", "_home", "_b")
    return out.withColumns({prefix + "lo": F.col(prefix + "mean") - F.col(prefix + "std"),
                            prefix + "hi": F.col(prefix + "mean") + F.col(prefix + "std")})


def row_ranks(df: DataFrame, keys: list[str], timestamp_col: str, tie_cols: list[str],
              bucket_hours: int = DEFAULT_BUCKET_HOURS, out_col: str = "_rank") -> DataFrame:
    """Adds each row's number (from 0) in its series by time, then ``tie_cols``: rows of earlier buckets, a prefix
    sum over one row per bucket, plus its place in its own bucket."""
    b = df.withColumn("_bk", _bucket(tc.hour_number(timestamp_col), bucket_hours))
    inner = b.withColumn("_in", F.row_number().over(Window.partitionBy(*keys, "_bk").orderBy(timestamp_col, *tie_cols)) - 1)
    per = b.groupBy(*keys, "_bk").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_bk")).rowsBetween(Window.unboundedPreceding, -1))
    offsets = per.select(*keys, "_bk", F.coalesce(before, F.lit(0)).alias("_off"))
    return join_on_keys(inner, offsets, [*keys, "_bk"]).withColumn(out_col, F.col("_in") + F.col("_off")).drop("_bk", "_in", "_off")


def rolling_rows(df: DataFrame, keys: list[str], timestamp_col: str, value_col: str, window: int = 24, center: bool = True,
                 min_periods: int | None = None, tie_cols: list[str] | None = None, bucket_rows: int = 4096, prefix: str = "rolling_") -> DataFrame:
    """W1 on a series with gaps: pandas ``rolling(window, center=center)`` over the rows that exist, whatever
    the hours between them.

    Rows are numbered (``row_ranks``), cut into buckets of ``bucket_rows`` ranks, and each bucket gets the neighbouring
    ranks its frames need, so no series is in one task. Rows of one time are ordered by
    ``tie_cols`` (default: the value). Same outputs as ``rolling_stats``.
    """
    back = window // 2 if center else window - 1
    ahead = window - 1 - back
    min_periods = window if min_periods is None else min_periods
    size = max(bucket_rows, window)
    ranked = row_ranks(df, keys, timestamp_col, [value_col] if tie_cols is None else tie_cols).withColumn("_home", _bucket(F.col("_rank"), size))
    near = F.array_distinct(F.array("_home", _bucket(F.col("_rank") - ahead, size), _bucket(F.col("_rank") + back, size)))
    copies = ranked.withColumn("_b", F.explode(near))
    w = Window.partitionBy(*keys, "_b").orderBy("_rank").rowsBetween(-back, ahead)
    v = F.col(value_col)
    cnt = F.count(v).over(w)
    out = copies.withColumns({prefix + "mean": F.when(cnt >= min_periods, F.avg(v).over(w)), prefix + "std": F.when(cnt >= min_periods, F.stddev_samp(v).over(w))})
    out = out.filter(F.col("_b") == F.col("_home")).drop("_rank", "_home", "_b")
    return out.withColumns({prefix + "lo": F.col(prefix + "mean") - F.col(prefix + "std"), prefix + "hi": F.col(prefix + "mean") + F.col(prefix + "std")})


# ---------------------------------------------------------------------------
# Cross-bucket carries (lag, forward fill)
# ---------------------------------------------------------------------------

def add_prev_and_fill(df: DataFrame, keys: list[str], timestamp_col: str, value_col: str,
                      bucket_hours: int = DEFAULT_BUCKET_HOURS, ord_col: str | None = None) -> DataFrame:
    """Adds, per row of each series ordered by ``timestamp_col``:

    * ``_prev``: the value on the previous row (row-based lag; NULL on the first),
    * ``_prev_exists``: whether a previous row exists,
    * ``_ffill``: last non-null value at or before this row,
    * ``_ffill_prev``: last non-null value strictly before this row.

    Rows are windowed per (key, bucket). The per-bucket summary (last row, last
    non-null value) is aggregated from those windowed rows, which are already
    partitioned by (key, bucket), so it adds no exchange over the data; the
    carry-in window runs over one row per bucket and joins back on
    (key, bucket).
    """
    ord_col = ord_col or timestamp_col
    b = df.withColumn("_bk", _bucket(tc.hour_number(timestamp_col), bucket_hours))
    w = Window.partitionBy(*keys, "_bk").orderBy(ord_col)
    wcum = w.rowsBetween(Window.unboundedPreceding, 0)
    wbef = w.rowsBetween(Window.unboundedPreceding, -1)
    v, o = F.col(value_col), F.col(ord_col)
    inner = b.withColumns({
        "_rn": F.row_number().over(w),
        "_lag": F.lag(v).over(w),
        "_f_in": F.last(v, ignorenulls=True).over(wcum),
        "_f_bef": F.last(v, ignorenulls=True).over(wbef),
    })
    summ = inner.groupBy(*keys, "_bk").agg(F.max_by(v, o).alias("_s_last"), F.max(o).alias("_s_ord"),
                                           F.max_by(v, F.when(v.isNotNull(), o)).alias("_s_nn"))
    ws = Window.partitionBy(*keys).orderBy("_bk")
    carry = summ.select(*keys, "_bk", F.lag("_s_last").over(ws).alias("_lag_in"),
                        F.lag("_s_ord").over(ws).alias("_lag_in_ord"),
                        F.last("_s_nn", ignorenulls=True).over(ws.rowsBetween(Window.unboundedPreceding, -1))
                        .alias("_fill_in"))
    j = join_on_keys(inner, carry, [*keys, "_bk"], "left")
    first = F.col("_rn") == 1
    return j.select(
        *df.columns,
        F.when(first, F.col("_lag_in")).otherwise(F.col("_lag")).alias("_prev"),
        F.when(first, F.col("_lag_in_ord").isNotNull()).otherwise(F.lit(True)).alias("_prev_exists"),
        F.coalesce("_f_in", "_fill_in").alias("_ffill"),
        F.coalesce("_f_bef", "_fill_in").alias("_ffill_prev"))


def add_fills(df: DataFrame, keys: list[str], timestamp_col: str, value_col: str,
              bucket_hours: int = DEFAULT_BUCKET_HOURS, ord_col: str | None = None) -> DataFrame:
    """Adds ``_ffill`` (last non-null value at or before the row) and ``_bfill``
    (first non-null value at or after it), per series, in one windowed pass.

    Same bucketed scheme as ``add_prev_and_fill``: a per-bucket summary of the
    first and last non-null values, windows over one row per bucket for the
    carry in each direction, and a join back.
    """
    ord_col = ord_col or timestamp_col
    b = df.withColumn("_bk", _bucket(tc.hour_number(timestamp_col), bucket_hours))
    w = Window.partitionBy(*keys, "_bk").orderBy(ord_col)
    v, o = F.col(value_col), F.col(ord_col)
    inner = b.withColumns({
        "_f_in": F.last(v, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "_b_in": F.first(v, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)),
    })
    nn = F.when(v.isNotNull(), o)
    summ = inner.groupBy(*keys, "_bk").agg(F.max_by(v, nn).alias("_s_last"), F.min_by(v, nn).alias("_s_first"))
    ws = Window.partitionBy(*keys).orderBy("_bk")
    carry = summ.select(
        *keys, "_bk",
        F.last("_s_last", ignorenulls=True).over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias("_fill_in"),
        F.first("_s_first", ignorenulls=True).over(ws.rowsBetween(1, Window.unboundedFollowing)).alias("_bfill_in"))
    j = join_on_keys(inner, carry, [*keys, "_bk"], "left")
    return j.select(*df.columns, F.coalesce("_f_in", "_fill_in").alias("_ffill"),
                    F.coalesce("_b_in", "_bfill_in").alias("_bfill"))


def changes(df: DataFrame, keys: list[str], timestamp_col: str, value_col: str,
            fill: bool = True, bucket_hours: int = DEFAULT_BUCKET_HOURS) -> DataFrame:
    """W2 + W3: ``diff`` = x - previous x; ``pct_change`` = 100 * (f / f_prev - 1).

    ``fill=True`` reproduces pandas 2.x ``pct_change()`` which forward-fills
    first (Q6); a zero divisor gives NULL instead of inf (Q7).
    """
    j = add_prev_and_fill(df, keys, timestamp_col, value_col, bucket_hours)
    v = F.col(value_col)
    if fill:
        pct = (safe_div(F.col("_ffill"), F.col("_ffill_prev")) - 1) * 100
        pct = F.when(F.col("_ffill").isNotNull(), pct)
    else:
        pct = (safe_div(v, F.col("_prev")) - 1) * 100
    return j.withColumns({"diff": v - F.col("_prev"), "pct_change": pct}) \
        .drop("_prev", "_prev_exists", "_ffill", "_ffill_prev")


def gaps(df: DataFrame, keys: list[str], timestamp_col: str = "timestamp",
         threshold_hours: float = 1.5, bucket_hours: int = DEFAULT_BUCKET_HOURS) -> DataFrame:
    """Rows that follow a step longer than ``threshold_hours`` in a series.

    Output: keys, ``timestamp`` (row after the gap), ``previous``, ``gap_hours``
    and ``missing_hours`` (whole hours absent in between).
    """
    d = df.select(*keys, F.col(timestamp_col).alias("_ts")).filter(F.col("_ts").isNotNull())
    j = add_prev_and_fill(d.withColumn("_tsv", F.col("_ts")), keys, "_ts", "_tsv", bucket_hours)
    secs = tc.seconds_between(F.col("_prev"), F.col("_ts"))
    out = j.filter(F.col("_prev").isNotNull() & (secs > F.lit(threshold_hours * 3600)))
    return out.select(*keys, F.col("_ts").alias(timestamp_col), F.col("_prev").alias("previous"),
                      (secs / 3600.0).alias("gap_hours"),
                      (tc.hour_number("_ts") - tc.hour_number("_prev") - 1).alias("missing_hours"))


def step_check(df: DataFrame, keys: list[str], timestamp_col: str = "timestamp",
               bucket_hours: int = DEFAULT_BUCKET_HOURS) -> DataFrame:
    """Per series, how many steps differ from exactly one hour."""
    d = df.select(*keys, F.col(timestamp_col).alias("_ts"))
    j = add_prev_and_fill(d.withColumn("_tsv", F.col("_ts")), keys, "_ts", "_tsv", bucket_hours)
    secs = tc.seconds_between(F.col("_prev"), F.col("_ts"))
    return j.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"),
                                F.count_if(F.col("_prev").isNotNull() & (secs != 3600)).alias("bad_steps"))


# ---------------------------------------------------------------------------
# Coverage islands
# ---------------------------------------------------------------------------

def islands(df: DataFrame, keys: list[str], timestamp_col: str = "timestamp", step_hours: int = 1,
            bucket_hours: int = DEFAULT_BUCKET_HOURS) -> DataFrame:
    """W4 turned round: the unbroken stretches of every series.

    Output: keys, ``start``, ``end`` (first and last hour) and ``hours`` present. A stretch ends where the next
    hour of the series is more than ``step_hours`` later. Breaks are marked against the row before (carried over
    bucket edges), numbered by a prefix sum, and stretches are grouped by that number, so one that holds
    most of the rows is combined map-side. Rows without a time belong to no stretch; repeats of an hour count once.
    """
    hours = df.select(*keys, tc.trunc_hour(timestamp_col).alias("_ts")).filter(F.col("_ts").isNotNull()).distinct()
    j = add_prev_and_fill(hours.withColumn("_tsv", F.col("_ts")), keys, "_ts", "_tsv", bucket_hours)
    broken = F.col("_prev").isNull() | (tc.hour_number("_ts") - tc.hour_number("_prev") > step_hours)
    marked = j.select(*keys, "_ts", tc.hour_number("_ts").alias("_hn"), F.when(broken, 1).otherwise(0).cast("bigint").alias("_mark"))
    numbered = prefix_sum(marked, keys, "_hn", "_mark", out_col="_before").withColumn("_island", F.col("_before") + F.col("_mark"))
    return numbered.groupBy(*keys, "_island").agg(F.min("_ts").alias("start"), F.max("_ts").alias("end"), F.count(F.lit(1)).alias("hours")).drop("_island")


def joint_islands(stretches: DataFrame, keys: list[str], series: int | None = None, step_hours: int = 1,
                  bucket_hours: int = DEFAULT_BUCKET_HOURS) -> DataFrame:
    """Intersection of the stretches of all series (``islands`` with the same ``step_hours``): ``start``, ``end``, ``hours``.

    A sweep without a join of intervals: a stretch adds one at its start and takes one away after its end; where the prefix
    sum of these changes is the number of series (counted, if not given), all are present until the next change.
    """
    # a NULL key is a series too
    n = F.lit(series).cast("bigint") if series is not None else None
    after = tc.add_hours("end", step_hours)
    change = F.explode(F.array(F.struct(F.col("start").alias("_ts"), F.lit(1).cast("bigint").alias("_d")), F.struct(after.alias("_ts"), F.lit(-1).cast("bigint").alias("_d"))))
    changes_ = stretches.select(change.alias("c")).select("c.*").groupBy("_ts").agg(F.sum("_d").alias("_d")).filter("_d <> 0")
    # all changes are one series: its carries, like those of any single series, run over one row per band or bucket
    one = changes_.withColumns({"_hn": tc.hour_number("_ts"), "_all": F.year("_ts") % 1})
    active = prefix_sum(one, ["_all"], "_hn", "_d", out_col="_before").withColumn("_v", F.struct("_ts", (F.col("_before") + F.col("_d")).alias("n")))
    j = add_prev_and_fill(active.select("_all", "_ts", "_v"), ["_all"], "_ts", "_v", bucket_hours)
    found = j.filter("_prev IS NOT NULL").select(F.col("_prev._ts").alias("start"), tc.add_hours("_ts", -step_hours).alias("end"), F.col("_prev.n").alias("_n"), "_all")
    if n is None:
        total = stretches.select(*keys).distinct().agg(F.count(F.lit(1)).alias("_series")).withColumn("_all", F.lit(0))
        found = join_on_keys(found, total, ["_all"])
        n = F.col("_series")
    hours = tc.hour_number("end") - tc.hour_number("start") + 1
    return found.filter(F.col("_n") == n).select("start", "end", hours.alias("hours"))


# ---------------------------------------------------------------------------
# Duration curve as a step table, markers, optional row expansion
# ---------------------------------------------------------------------------

STEPS_PER_OCTAVE = 4096


def value_band(col: Column) -> Column:
    """A whole number that grows with the value: its octave and 1/4096 of that.

    The same relative width at every scale, so values in [0, 1] and up to 1e9 spread
    alike, and it needs no look at the data. NULL stays NULL (a band of its own); NaN and
    infinities come after everything else.
    """
    x = F.abs(col)
    octave = F.floor(F.log2(x))
    step = (octave + F.lit(1100)) * F.lit(STEPS_PER_OCTAVE) + F.floor(x / F.pow(F.lit(2.0), octave) * F.lit(STEPS_PER_OCTAVE))
    top = F.lit(1 << 40).cast("bigint")
    size = F.when(x == 0, F.lit(0).cast("bigint")).when(x < F.lit(1e300), F.when(x > F.lit(1e-300), step).otherwise(F.lit(1)).cast("bigint")).otherwise(top)
    return F.when(col.isNotNull(), F.when(F.isnan(col), top + 1).when(col < 0, -size).otherwise(size))


def prefix_sum(df: DataFrame, group_cols: list[str], order_col: str, value_col: str,
               descending: bool = False, out_col: str = "sum_before", total_col: str | None = None) -> DataFrame:
    """Exact running sum without a window over a whole group.

    Adds ``out_col`` = sum of ``value_col`` over rows of the same group that come strictly
    before the row in ``order_col`` order (NULL orders last; ``order_col`` values should be
    distinct within a group, e.g. after an aggregation by them). Two levels: bands of
    the order value (``value_band``) are summed and prefix-summed over one row per band, then
    rows are prefix-summed inside their band. A group holding a third of all rows is
    therefore spread over its bands, at any scale of values. ``total_col`` adds the group
    total. NULL group keys are a group like any other.
    """
    ks = list(group_cols) or ["_g"]
    d = df if group_cols else df.withColumn("_g", F.lit(0))
    d = d.withColumn("_band", value_band(F.col(order_col).cast("double")))
    bands = d.groupBy(*ks, "_band").agg(F.sum(value_col).alias("_bsum"))
    border = F.col("_band").desc_nulls_last() if descending else F.col("_band").asc_nulls_last()
    wk = Window.partitionBy(*ks)
    wb = wk.orderBy(border).rowsBetween(Window.unboundedPreceding, -1)
    sel = [*ks, "_band", F.coalesce(F.sum("_bsum").over(wb), F.lit(0)).alias("_boff")]
    if total_col:
        sel.append(F.sum("_bsum").over(wk).alias(total_col))
    j = join_on_keys(d, bands.select(*sel), [*ks, "_band"])
    vorder = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()
    wi = Window.partitionBy(*ks, "_band").orderBy(vorder).rowsBetween(Window.unboundedPreceding, -1)
    out = j.withColumn(out_col, F.col("_boff") + F.coalesce(F.sum(value_col).over(wi), F.lit(0))) \
        .drop("_band", "_boff")
    return out if group_cols else out.drop("_g")


def value_ranks(df: DataFrame, keys: list[str], value_col: str, descending: bool = False) -> DataFrame:
    """One row per (key, distinct value): ``_v``, ``n_rows``, ``rank_first`` (rows before it)
    and ``n_total``; the common base of duration curves and exact quantiles."""
    freq = df.select(*keys, F.col(value_col).alias("_v")).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("n_rows"))
    return prefix_sum(freq, keys, "_v", "n_rows", descending=descending, out_col="rank_first", total_col="n_total")


def duration_steps(df: DataFrame, keys: list[str], value_col: str, drop_nulls: bool = False) -> DataFrame:
    """W5 in exact compressed form: one row per (key, distinct value).

    Sorting a series descending (NULLs last) and numbering rows from 0 gives,
    for each distinct value, a run of ranks ``rank_first..rank_last``;
    ``position = 100 * rank / n`` with ``n`` all rows (NULLs included, Q10).
    ``rank_first`` is the number of rows with a larger value: a ``prefix_sum``
    of the value counts, so no window ever holds a whole series. ``drop_nulls``
    removes NULL values before counting.
    """
    d = df.filter(F.col(value_col).isNotNull()) if drop_nulls else df
    last = F.col("rank_first") + F.col("n_rows") - 1
    return value_ranks(d, keys, value_col, descending=True).select(
        *keys, F.col("_v").alias(value_col), "n_rows", "rank_first", last.alias("rank_last"), "n_total",
        (F.col("rank_first") * 100.0 / F.col("n_total")).alias("position_first"),
        (last * 100.0 / F.col("n_total")).alias("position_last"))


def duration_markers(steps: DataFrame, keys: list[str], value_col: str,
                     percents=(10, 25, 50, 75, 90)) -> DataFrame:
    """Value at index ``int(p * n / 100)`` of the descending curve, per key.

    One aggregate over the step table: for each marker, the step with the
    largest ``rank_first`` not beyond the index.
    """
    idx = {p: F.floor(F.lit(p) * F.col("n_total") / F.lit(100)) for p in percents}
    return steps.groupBy(*keys).agg(
        F.max("n_total").alias("n_total"),
        *[F.max_by(F.col(value_col), F.when(F.col("rank_first") <= idx[p], F.col("rank_first"))).alias(f"p{p}")
          for p in percents])


def duration_rows(steps: DataFrame, keys: list[str], value_col: str, chunk: int = 65536) -> DataFrame:
    """W5 per-row curve ``(keys, rank, position, value)`` from the step table.

    Runs are cut into chunks of at most ``chunk`` ranks and the chunks are
    spread over tasks before expansion, so a value repeated in a third of the
    series does not expand inside one task.
    """
    starts = steps.select(*keys, value_col, "rank_first", "rank_last", "n_total",
                          F.explode(F.sequence(F.col("rank_first"), F.col("rank_last"),
                                               F.lit(chunk).cast("bigint"))).alias("_c0"))
    starts = starts.repartition(*[F.col(k) for k in keys], "_c0")
    rows = starts.select(*keys, value_col, "n_total",
                         F.explode(F.sequence(F.col("_c0"),
                                              F.least(F.col("_c0") + chunk - 1, F.col("rank_last")))).alias("rank"))
    return rows.select(*keys, "rank", (F.col("rank") * 100.0 / F.col("n_total")).alias("position"), value_col)
