"""Joins and set comparisons."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timecols as tc
from ..functions.keys import join_on_keys
from . import series as S


def align_pair(df: DataFrame, timestamp_col: str, key_col: str, value_col: str,
               a: str, b: str, a_name: str | None = None, b_name: str | None = None,
               inner: bool = True) -> DataFrame:
    """Two series side by side on the timestamp.

    Written as one grouped pass (conditional aggregation on the timestamp)
    rather than a self-join: one scan, one shuffle. With ``inner`` only
    timestamps present in both series are kept (the inner merge).
    """
    a_name, b_name = a_name or a, b_name or b
    k, v = F.col(key_col), F.col(value_col)
    g = df.filter(k.isin(a, b)).groupBy(timestamp_col).agg(
        F.max(F.when(k == a, v)).alias(a_name), F.max(F.when(k == b, v)).alias(b_name),
        F.max((k == a).cast("int")).alias("_has_a"), F.max((k == b).cast("int")).alias("_has_b"))
    if inner:
        g = g.filter((F.col("_has_a") == 1) & (F.col("_has_b") == 1))
    return g.drop("_has_a", "_has_b")


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left rows without a key match on the right (by key, not by a NULL test).

    Duplicate right keys do not change an anti join, so no distinct is taken. NULL keys
    match NULL keys.
    """
    return join_on_keys(left, right.select(*keys), keys, "left_anti")


def presence(df: DataFrame, keys: list[str], left, right) -> DataFrame:
    """One row per key of a tagged table: is it among the rows of ``left``, of ``right`` (conditions)?"""
    return df.groupBy(*keys).agg(F.max(F.coalesce(left, F.lit(False))).alias("_l"), F.max(F.coalesce(right, F.lit(False))).alias("_r"))


def key_alignment(df: DataFrame, keys: list[str], left, right) -> DataFrame:
    """Do two parts of one table (two conditions) hold the same keys? Counts of matched and
    one-sided keys, from one scan and one grouped pass; NULL keys count like others."""
    p = presence(df.filter(left | right), keys, left, right)
    return p.agg(F.count_if(F.col("_l") & F.col("_r")).alias("matched"),
                 F.count_if(F.col("_l") & ~F.col("_r")).alias("only_left"),
                 F.count_if(F.col("_r") & ~F.col("_l")).alias("only_right")) \
        .withColumn("aligned", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def _hour_bits(df: DataFrame, keys: list[str], timestamp_col: str, name: str) -> DataFrame:
    """One row per key and day: the hours that have a row, as the low 24 bits of a number."""
    h = tc.hour_number(timestamp_col)
    bit = F.call_function("shiftleft", F.lit(1), F.pmod(h, F.lit(24)).cast("int")).cast("bigint")
    day = ((h - F.pmod(h, F.lit(24))) / 24).cast("bigint")
    return df.filter(F.col(timestamp_col).isNotNull()).groupBy(*keys, day.alias("_day")).agg(F.bit_or(bit).alias(name))


def key_shift(left: DataFrame, right: DataFrame, keys: list[str], timestamp_col: str = "timestamp", period: str = "month",
              max_shift: int = 24) -> DataFrame:
    """Q-merge-diag: by how many hours the right side's stamps run ahead of the left's, per series and period.

    Each day's hours become a 24-bit number; for every shift within ``max_shift`` (at most 24) the
    left day's bits are compared with those hours of the right side, and the differing ones
    are summed per period. The shift with the fewest differences wins, ties going to the smaller
    one, then to the later side. Output: keys, ``period_start``, ``shift_hours``, ``agreement`` (share of the compared
    hours that are alike at that shift), ``agreement_unshifted`` and ``hours_left``.

    One row per key and day reaches the comparison, whatever the number of rows; each right day is given
    to the three days it can overlap, in one grouped pass without a join. Days without left rows are not compared.
    Duplicates count once; rows without a stamp are left out; NULL keys are a series of their own.
    """
    if not 0 <= max_shift <= 24:
        raise ValueError("max_shift must be from 0 to 24 hours")
    lb = _hour_bits(left, keys, timestamp_col, "_l").select(*keys, "_day", "_l", F.lit(None).cast("int").alias("_at"), F.lit(None).cast("bigint").alias("_r"))
    rb = _hour_bits(right, keys, timestamp_col, "_r").withColumn("_at", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    rb = rb.select(*keys, (F.col("_day") - F.col("_at")).alias("_day"), F.lit(None).cast("bigint").alias("_l"), "_at", "_r")
    # bits of the day before, the day and the day after, in one 72-hour strip: two numbers, as a long has 63
    days = lb.unionByName(rb).groupBy(*keys, "_day").agg(
        F.max("_l").alias("_l"), *[F.coalesce(F.max(F.when(F.col("_at") == i, F.col("_r"))), F.lit(0).cast("bigint")).alias(n) for i, n in ((-1, "_b"), (0, "_c"), (1, "_a"))])
    days = days.filter("_l IS NOT NULL")
    shifts = F.explode(F.sequence(F.lit(-max_shift), F.lit(max_shift))).alias("shift_hours")
    # hour h + shift of the right side at place h: from the strip of two days that the shift reaches
    strip = F.expr("CASE WHEN shift_hours < 0 THEN _b + shiftleft(_c, 24) ELSE _c + shiftleft(_a, 24) END")
    moved = F.expr("shiftright(_s, CASE WHEN shift_hours < 0 THEN 24 + shift_hours ELSE shift_hours END) & 16777215")
    votes = days.select("*", shifts).withColumn("_s", strip).withColumn("_off", F.bit_count(F.expr("_l").bitwiseXOR(moved)))
    start = F.to_date(F.date_trunc(period, F.date_add(F.lit("1970-01-01").cast("date"), F.col("_day").cast("int")))).cast("timestamp_ntz")
    sums = votes.groupBy(*keys, start.alias("period_start"), "shift_hours").agg(
        F.sum("_off").alias("_off"), F.sum(F.lit(24)).alias("_n"), F.sum(F.bit_count("_l")).alias("hours_left"))
    best = F.min(F.struct("_off", F.abs("shift_hours").alias("_abs"), (-F.col("shift_hours")).alias("_neg")))
    out = sums.groupBy(*keys, "period_start").agg(best.alias("_best"), F.max(F.when(F.col("shift_hours") == 0, F.col("_off"))).alias("_zero"),
                                                  F.max("_n").alias("_n"), F.max("hours_left").alias("hours_left"))
    return out.select(*keys, "period_start", (-F.col("_best._neg")).alias("shift_hours"), (1 - F.col("_best._off") / F.col("_n")).alias("agreement"),
                      (1 - F.col("_zero") / F.col("_n")).alias("agreement_unshifted"), "hours_left")


def key_overlap(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Size of the distinct-key intersection of two columns."""
    return a.select(col).intersect(b.select(col)).agg(F.count(F.lit(1)).alias("overlap"))


def series_equal(df: DataFrame, key_cols: list[str], value_col: str, left, right) -> DataFrame:
    """Are two keyed series (two conditions on one table) equal everywhere?

    One scan and one grouped pass over the keys. NULL-safe, with a NaN flag:
    ``np.array_equal`` treats NaN as unequal; here NaN on both sides is reported in
    ``nan_pairs`` and counted as equal. A key on one side only is a difference even
    when the present value is NULL; several rows of one key and side compare by
    their largest value.
    """
    v = F.col(value_col)
    g = df.filter(left | right).groupBy(*key_cols).agg(
        F.max(F.when(left, v)).alias("_x"), F.max(F.when(right, v)).alias("_y"),
        F.max(F.coalesce(left, F.lit(False))).alias("_pa"), F.max(F.coalesce(right, F.lit(False))).alias("_pb"))
    same = F.col("_pa") & F.col("_pb") & F.col("_x").eqNullSafe(F.col("_y"))
    return g.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.bool_and(same), F.lit(True)).alias("equal"),
                 F.count_if(~same).alias("n_different"),
                 F.count_if(F.isnan("_x") & F.isnan("_y")).alias("nan_pairs"))


def nearest_match(left: DataFrame, right: DataFrame, keys: list[str], timestamp_col: str = "timestamp",
                  bucket_hours: int = 24) -> DataFrame:
    """For each distinct left (key, timestamp), the nearest right timestamp.

    Both sides are unioned and ordered by (time, side) with left rows first at
    the same instant. One bucketed pass (``series.add_fills``) gives the last
    right timestamp at or before each left row and the first at or after it
    (exact, unbounded reach, no window over a whole key). The smaller absolute
    gap wins, the earlier one on a tie. Output: keys, ``timestamp``,
    ``nearest`` and ``diff_seconds`` (nearest - timestamp, signed seconds as
    DOUBLE); NULL when the key has no right rows.
    """
    l = left.select(*keys, F.col(timestamp_col).alias("_t")).filter(F.col("_t").isNotNull()).distinct() \
        .select(*keys, "_t", F.lit(None).cast("timestamp_ntz").alias("_r"), F.lit(0).alias("_side"))
    r = right.select(*keys, F.col(timestamp_col).alias("_t")).filter(F.col("_t").isNotNull()).distinct() \
        .select(*keys, "_t", F.col("_t").alias("_r"), F.lit(1).alias("_side"))
    u = l.unionByName(r).withColumn("_ord", F.struct(F.col("_t"), F.col("_side")))
    j = S.add_fills(u, keys, "_t", "_r", bucket_hours, ord_col="_ord").filter(F.col("_side") == 0)
    dp = tc.seconds_between("_t", "_ffill")
    dn = tc.seconds_between("_t", "_bfill")
    choose_prev = F.col("_bfill").isNull() | (F.col("_ffill").isNotNull() & (F.abs(dp) <= F.abs(dn)))
    nearest = F.when(choose_prev, F.col("_ffill")).otherwise(F.col("_bfill"))
    out = j.select(*keys, F.col("_t").alias(timestamp_col), nearest.alias("nearest"))
    # seconds as DOUBLE, like a timedelta's total_seconds()
    return out.withColumn("diff_seconds", tc.seconds_between(timestamp_col, "nearest").cast("double"))
