"""Time axis: UTC normalisation, gapless hour spines, calendar features."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import timecols as tc
from ..functions.keys import join_on_keys

DEFAULT_POLICY = ("2022-06-15", "2023-12-31")


def normalize_to_utc(df: DataFrame, timestamp_col: str = "timestamp",
                     source_tz: str = "UTC") -> DataFrame:
    """Return ``timestamp_col`` as UTC wall time (TIMESTAMP_NTZ).

    * TIMESTAMP (an instant, "zone aware") is converted exactly via its micros.
    * TIMESTAMP_NTZ ("naive") is read as wall time in ``source_tz`` (UTC default,
      i.e. naive means UTC) and converted to UTC.
    """
    dtype = df.schema[timestamp_col].dataType
    if isinstance(dtype, T.TimestampType):
        out = tc.instant_to_utc_ntz(timestamp_col)
    elif isinstance(dtype, T.TimestampNTZType):
        out = tc.local_to_utc(timestamp_col, source_tz)
    else:
        out = tc.local_to_utc(F.to_timestamp_ntz(F.col(timestamp_col).cast("string")), source_tz)
    return df.withColumn(timestamp_col, out)


def _days(start, end) -> tuple[_dt.date, _dt.date]:
    s = _dt.date.fromisoformat(str(start)[:10])
    e = _dt.date.fromisoformat(str(end)[:10])
    return s, e


def hour_spine(spark: SparkSession, start_date, end_date,
               timestamp_col: str = "timestamp", num_partitions: int | None = None) -> DataFrame:
    """Every hour from ``start_date`` 00:00 through ``end_date`` 23:00 (inclusive).

    Generated with ``spark.range`` so the rows are produced in parallel, never
    from one exploded row.
    """
    s, e = _days(start_date, end_date)
    n_hours = ((e - s).days + 1) * 24
    if n_hours <= 0:
        n_hours = 0
    rng = spark.range(0, n_hours, 1, num_partitions) if num_partitions else spark.range(0, n_hours)
    return rng.select(tc.add_hours(tc.ntz(s), F.col("id")).alias(timestamp_col))


def keyed_hour_spine(bounds: DataFrame, key_cols: list[str], first_day: str, last_day: str,
                     timestamp_col: str = "timestamp") -> DataFrame:
    """T2 + T3 without a cross join: one row per key and hour.

    ``bounds`` holds one row per key with a first and last DATE. Days are exploded
    first, then the 24 hours of each day, so no single row expands into a whole
    series.
    """
    days = bounds.select(*key_cols, F.explode(F.sequence(F.col(first_day), F.col(last_day))).alias("_day"))
    hours = days.select(*key_cols, "_day", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"))
    return hours.select(
        tc.add_hours(F.col("_day").cast("timestamp_ntz"), F.col("_h")).alias(timestamp_col),
        *key_cols)


def shared_day_bounds(series: DataFrame, key_cols: list[str], timestamp_col: str = "timestamp") -> DataFrame:
    """Per key, the first and last day of the *whole* data set (one panel range).

    The per-key table (one row per series) is shuffled by key and read twice from that
    shuffle: as it is, and summed to one row, which is broadcast to it. No window or task
    sees all keys. Takes raw rows as well as hourly ones.
    """
    per_key = series.groupBy(*key_cols).agg(
        F.min(F.to_date(timestamp_col)).alias("_lo"), F.max(F.to_date(timestamp_col)).alias("_hi"))
    per_key = per_key.filter(F.col("_lo").isNotNull())
    whole = per_key.agg(F.min("_lo").alias("first_day"), F.max("_hi").alias("last_day"))
    # the key is 0 on both sides, from a column so that it stays an equi-join
    whole = whole.withColumn("_one", F.year("first_day") * 0)
    return per_key.withColumn("_one", F.year("_lo") * 0).join(F.broadcast(whole), "_one").select(*key_cols, "first_day", "last_day")


def add_time_features(df: DataFrame, timestamp_col: str = "timestamp",
                      policy: tuple[str, str] | None = DEFAULT_POLICY,
                      flag_col: str = "in_policy") -> DataFrame:
    """T4 + T5: hour, day_of_week (Mon=0), month, year, quarter, day_of_year,
    is_weekend and the inclusive policy flag."""
    cols = tc.calendar_columns(timestamp_col)
    if policy is not None:
        cols[flag_col] = tc.in_window(timestamp_col, *policy)
    return df.withColumns(cols)


def add_phase(df: DataFrame, timestamp_col: str = "timestamp", mode: str = "three",
              policy: tuple[str, str] = DEFAULT_POLICY, flag_col: str = "in_policy",
              phase_col: str = "phase") -> DataFrame:
    """``mode`` = 'flag' (pre = not during), 'start' (split at the
    start only) or 'three' (before / during / after)."""
    if mode == "flag":
        return df.withColumn(phase_col, tc.phase2(flag_col))
    if mode == "start":
        return df.withColumn(phase_col, tc.phase_by_start(timestamp_col, policy[0]))
    return df.withColumn(phase_col, tc.phase3(timestamp_col, *policy))


def hour_labels_to_timestamp(df: DataFrame, date_col: str, hour_index_col: str,
                             mode: str = "label", market_tz: str = "Europe/Madrid",
                             timestamp_col: str = "timestamp") -> DataFrame:
    """Hour index ``i`` (0-based) of a market day to a UTC timestamp.

    * ``label``: ``date + i h`` stamped as UTC (the loaders' behaviour, Q2).
    * ``market``: local midnight converted to UTC, plus ``i`` elapsed hours, so a
      23-hour spring day and a 25-hour autumn day (``H25``) map to true instants.
    """
    midnight = F.col(date_col).cast("timestamp_ntz")
    if mode == "market":
        midnight = tc.local_to_utc(midnight, market_tz)
    elif mode != "label":
        raise ValueError("mode must be 'label' or 'market'")
    return df.withColumn(timestamp_col, tc.add_hours(midnight, F.col(hour_index_col)))


STAMP_STATUS = ["ok", "first", "second", "single", "surplus", "nonexistent", "unparsed"]


def resolve_local_stamps(df: DataFrame, key_cols: list[str], order_col: str, stamp_col: str, market_tz: str = "Europe/Madrid",
                         timestamp_col: str = "timestamp", status_col: str = "stamp_status") -> DataFrame:
    """Plain market-local text stamps to UTC, the repeated autumn hour told apart by row order.

    In the hour that the clock passes twice a series' rows, in order, form runs of rising stamps: the first
    run is summer time, the second winter time. The status of each row: ``ok``; ``first`` and ``second``; ``single`` (only one
    run was delivered: summer time is assumed); ``surplus`` (a third or later run, or a repeat of the row order: winter time);
    ``nonexistent`` (the hour that spring skips) and ``unparsed`` have a NULL timestamp.

    Only rows of repeated hours enter the windows, which run per series and local day; all others are
    single expressions. NULL keys are a series of their own; rows without an order come first.
    """
    local = F.col("_local")
    hour = F.expr("INTERVAL 1 HOUR")

    def back(utc):
        return F.convert_timezone(F.lit("UTC"), F.lit(market_tz), utc)
    b = df.withColumn("_local", tc.parse_timestamp(stamp_col)).withColumn("_utc", tc.local_to_utc(local, market_tz))
    kind = (F.when(local.isNull(), "unparsed").when(back(F.col("_utc")) != local, "nonexistent")
            .when((back(F.col("_utc") + hour) == local) | (back(F.col("_utc") - hour) == local), "twice").otherwise("ok"))
    b = b.withColumn("_kind", kind)
    plain = b.filter("_kind <> 'twice'").withColumns({
        timestamp_col: F.when(F.col("_kind") == "ok", F.col("_utc")), status_col: F.col("_kind")})
    day = [*key_cols, F.to_date("_local")]
    rows = Window.partitionBy(*day).orderBy(F.col(order_col).asc_nulls_first(), "_local")
    twice = b.filter("_kind = 'twice'").withColumn("_falls", (local <= F.lag("_local").over(rows)).cast("int"))
    twice = twice.withColumn("_run", F.sum(F.coalesce("_falls", F.lit(0))).over(rows.rowsBetween(Window.unboundedPreceding, 0)))
    twice = twice.withColumn("_runs", F.max("_run").over(Window.partitionBy(*day)))
    # the earlier of the two instants, whichever one the conversion gives
    summer = F.when(back(F.col("_utc") - hour) == local, F.col("_utc") - hour).otherwise(F.col("_utc"))
    status = (F.when(F.col("_runs") == 0, "single").when(F.col("_run") == 0, "first").when(F.col("_run") == 1, "second").otherwise("surplus"))
    twice = twice.withColumns({timestamp_col: F.when(F.col("_run") == 0, summer).otherwise(summer + hour), status_col: status})
    keep = [*df.columns, timestamp_col, status_col]
    return plain.select(*keep).unionByName(twice.select(*keep))


def resample(df: DataFrame, key_cols: list[str], timestamp_col: str, value_col: str,
             unit: str = "month", aggs: tuple[str, ...] = ("mean",), extra: dict | None = None) -> DataFrame:
    """Calendar resample with empty periods kept (NULL aggregates).

    Output: keys, ``period_start`` (NTZ), ``period_end`` (DATE, last day of the
    period: the label pandas uses for month-end resampling), ``n`` and the
    requested aggregates among mean, min, max, sum, plus any ``extra``
    aggregate expressions (name -> Column) computed in the same grouped pass.
    Empty periods between a key's first and last period are inserted by
    ``fill_period_gaps`` (one pass over the grouped table, no spine join).
    """
    if unit not in ("day", "month"):
        raise ValueError("unit must be 'day' or 'month'")
    p = F.to_date(timestamp_col)
    if unit == "month":
        p = F.trunc(p, "month")
    fns = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum}
    v = F.col(value_col)
    exprs = [F.count(v).alias("n"), *[fns[a](v).alias(a) for a in aggs],
             *[e.alias(name) for name, e in (extra or {}).items()]]
    grouped = df.groupBy(*key_cols, p.cast("timestamp_ntz").alias("period_start")).agg(*exprs)
    grouped = grouped.filter(F.col("period_start").isNotNull())
    filled = fill_period_gaps(grouped, "period_start", key_cols, unit)
    end = F.to_date("period_start") if unit == "day" else F.last_day("period_start")
    return filled.select(*key_cols, "period_start", end.alias("period_end"),
                         F.coalesce("n", F.lit(0)).alias("n"), *list(aggs), *list(extra or {}))


def fill_period_gaps(df: DataFrame, timestamp_col: str, key_cols: list[str] | None = None,
                     unit: str = "month") -> DataFrame:
    """Insert the missing periods between the first and last row of each key.

    For a table with one row per (key, period) (e.g. a monthly pivot), each row
    also emits the empty periods up to the next row (``lead`` over the table),
    with NULL values. Same result as a period spine left-joined with the table,
    but without a spine. Windows run per key and year; rows without a period are not
    expected (``resample`` removes them).
    """
    names = list(key_cols or [])
    step = "INTERVAL 1 DAY" if unit == "day" else "INTERVAL 1 MONTH"
    d = F.to_date(timestamp_col)
    # the next row is found within its year; a table of one row per year carries it over the edge
    b = (df if names else df.withColumn("_g", F.lit(0))).withColumn("_y", F.year(timestamp_col))
    ks = names or ["_g"]
    first = b.groupBy(*ks, "_y").agg(F.min(timestamp_col).alias("_first"))
    carry = first.select(*ks, "_y", F.lead("_first").over(Window.partitionBy(*ks).orderBy("_y")).alias("_carry"))
    inner = b.withColumn("_in", F.lead(timestamp_col).over(Window.partitionBy(*ks, "_y").orderBy(timestamp_col)))
    g = join_on_keys(inner, carry, [*ks, "_y"], "left").withColumn("_nx", F.coalesce("_in", "_carry"))
    nxt = F.to_date(F.col("_nx"))
    last = (F.date_sub(nxt, 1) if unit == "day" else F.add_months(nxt, -1))
    g = g.withColumn("_p", F.explode(F.sequence(d, F.coalesce(last, d), F.expr(step))))
    own = F.col("_p") == d
    values = [c for c in df.columns if c != timestamp_col and c not in names]
    return g.select(F.col("_p").cast("timestamp_ntz").alias(timestamp_col), *names,
                    *[F.when(own, F.col(c)).alias(c) for c in values])
