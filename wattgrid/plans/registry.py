"""Registered queries: one Spark plan per operator family, run on the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose column
names and types match its DuckDB twin in ``plans.oracle``.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc
from ..functions.numeric import combine_single_rows, ints_to_bigint, is_missing, round_doubles
from ..operators import dedupe as D
from ..operators import joins as J
from ..operators import quality as Q
from ..operators import reshape as R
from ..operators import series as S
from ..operators import stats as A
from ..operators import timeaxis as tx
from . import analytics as X
from . import standins as SI
from .loading import load_wide_prices, wide_price_rows  # noqa: F401  (re-exported)
from .oracle import PRIORITY_NAMES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
KEY, TS, PRICE = "country", "timestamp", "price_eur_mwh"
PA, PB = SI.PAIR


def finish(df: DataFrame) -> DataFrame:
    """Report boundary: DOUBLE rounded to 6 digits, integers widened to BIGINT and
    DATE given as a midnight TIMESTAMP_NTZ (one temporal type across clients)."""
    from pyspark.sql import types as T
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    if dates:
        df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in dates})
    return round_doubles(ints_to_bigint(df), 6)


def query(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: finish(fn(spark, sf_dir))
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


def _panel(spark, sf):
    return SI.panel(spark, sf)


@query("panel")
def q_panel(spark, sf):
    """Q-panel: gapless hour x series panel with weather and calendar features."""
    return _panel(spark, sf).select(TS, KEY, PRICE, "energy_mwh", "temperature_c", "wind_speed_100m", "hour",
                                    "day_of_week", "month", "year", "quarter", "day_of_year", "is_weekend",
                                    "in_policy")


@query("panel_incremental")
def q_panel_incremental(spark, sf):
    """Q-panel S9: the stored panel after three arrivals (days dealt by three, the last days first), each
    computing only the days it touches; equal to one full build."""
    import uuid
    from .incremental_panel import StoredPanel
    stored = StoredPanel(spark, f"wattgrid-panel-{uuid.uuid4().hex}", policy=SI.POLICY)
    hourly = SI.hourly_prices(spark, sf).select(TS, KEY, PRICE)
    for part in (2, 0, 1):
        stored.arrive(hourly.filter(F.dayofmonth(TS) % 3 == part))
    return stored.read()


@query("quantile_state")
def q_quantile_state(spark, sf):
    """Quartiles per series of the whole time and of the policy window, from value counts stored in three arrivals."""
    import uuid
    from ..session import checkpoint_dir
    from .quantile_state import QuantileState
    state = QuantileState(spark, f"{checkpoint_dir(spark).rstrip('/')}/wattgrid-quantiles-{uuid.uuid4().hex}", [KEY], TS, PRICE)
    hourly = SI.hourly_prices(spark, sf)
    for part in (2, 0, 1):
        state.add(hourly.filter(F.dayofmonth(TS) % 3 == part), f"arrival-{part}")
    named = {"q25": 0.25, "median": 0.5, "q75": 0.75, "p90": 0.9}
    spans = [state.quantiles(named, *span).withColumn("span", F.lit(name)) for name, span in (("all", (None, None)), ("policy", SI.POLICY))]
    return spans[0].unionByName(spans[1])


@query("panel_range")
def q_panel_range(spark, sf):
    """The panel written once (by year, sorted by series and time) and read back by a pushed half-open range."""
    import uuid
    from ..session import scratch_path
    from ..sources import files, sinks
    path = scratch_path(spark, f"panel-{uuid.uuid4().hex}")
    sinks.write_panel(_panel(spark, sf), path)
    return files.read_panel(spark, path, *SI.POLICY).select(TS, KEY, PRICE, "energy_mwh", "temperature_c", "hour", "is_weekend")


@query("named_sql")
def q_named_sql(spark, sf):
    """SQL with named parameters over views."""
    from ..sources import catalog
    SI.hourly_prices(spark, sf).createOrReplaceTempView("wattgrid_hourly")
    return catalog.execute_query(spark, """SELECT country, count(*) AS hours, avg(price_eur_mwh) AS mean FROM wattgrid_hourly
        WHERE timestamp >= CAST(:first AS TIMESTAMP_NTZ) AND timestamp < CAST(:last AS TIMESTAMP_NTZ) AND country <> :but GROUP BY country""",
                                 first=SI.POLICY[0], last=SI.POLICY[1], but=PB)


@query("csv_report")
def q_csv_report(spark, sf):
    """A summary written as CSV and read back with its types."""
    import uuid
    from ..session import scratch_path
    from ..sources import sinks
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    report = SI.hourly_prices(spark, sf).groupBy(KEY, F.hour(TS).cast("bigint").alias("hour")).agg(F.avg(PRICE).alias("mean"), F.count(PRICE).alias("n"))
    sinks.write_csv(report, path, single_file=True)
    return spark.read.option("header", True).schema(report.schema).csv(path)


@query("normalise_long")
def q_normalise_long(spark, sf):
    """A long file with other column names and order, brought to the prices table's schema by name."""
    import uuid
    from ..schemas import PRICES_DAY_AHEAD
    from ..session import scratch_path
    from ..sources import files
    path = scratch_path(spark, f"long-{uuid.uuid4().hex}")
    SI.hourly_prices(spark, sf).select(F.col(PRICE).alias("Price"), F.lit("x").alias("note"), F.col(KEY).alias("Zone"), F.col(TS).alias("Hour")).write.parquet(path)
    return files.normalise_long(spark.read.parquet(path), PRICES_DAY_AHEAD, {"Price": PRICE, "Zone": KEY, "Hour": TS})


@query("policy_impact")
def q_policy_impact(spark, sf):
    """Q-impact: pre vs during statistics per series and the policy effect."""
    return X.policy_impact(_panel(spark, sf))


@query("stats5")
def q_stats5(spark, sf):
    """Q-stats5: mean, median, std, P10, P90 per series and flag phase."""
    p = tx.add_phase(_panel(spark, sf), mode="flag")
    return X.phase_stats(p)


@query("phase_stats3")
def q_phase_stats3(spark, sf):
    """Q-stats5 by three phases before / during / after."""
    p = tx.add_phase(_panel(spark, sf), mode="three", policy=SI.POLICY)
    return X.phase_stats(p)


@query("coupling")
def q_coupling(spark, sf):
    """Q-coupling + Q-couple-label: correlation, differences, identical hours, label."""
    return X.coupling(_panel(spark, sf), PA, PB)


@query("divergence")
def q_divergence(spark, sf):
    """Q-split: hours where the two series diverge, by month and hour."""
    return X.divergence(_panel(spark, sf), PA, PB)


@query("duration_steps")
def q_duration_steps(spark, sf):
    """Duration curve as an exact step table per series."""
    return S.duration_steps(_panel(spark, sf), [KEY], PRICE)


@query("duration_markers")
def q_duration_markers(spark, sf):
    """P10..P90 markers of the duration curve per series."""
    return S.duration_markers(S.duration_steps(_panel(spark, sf), [KEY], PRICE), [KEY], PRICE)


@query("duration_curve")
def q_duration_curve(spark, sf):
    """The per-row duration curve (rank, position, price), expanded in chunks."""
    return S.duration_rows(S.duration_steps(_panel(spark, sf), [KEY], PRICE), [KEY], PRICE)


@query("hourly_profile")
def q_hourly_profile(spark, sf):
    """Q-hourly / A8 / W9: hourly mean, std and band per series."""
    return X.hourly_profile(_panel(spark, sf))


@query("daytype_hourly")
def q_daytype_hourly(spark, sf):
    """Hourly profile by weekday / weekend."""
    return X.hourly_profile(_panel(spark, sf), extra_keys=["is_weekend"])


@query("phase_hourly")
def q_phase_hourly(spark, sf):
    """Q-phase-hourly: hourly profile before / during / after."""
    p = tx.add_phase(_panel(spark, sf), mode="three", policy=SI.POLICY)
    return X.hourly_profile(p, extra_keys=["phase"])


@query("peak_trough")
def q_peak_trough(spark, sf):
    """Q-hourly / A15 / O4: peak and trough hour, first on ties."""
    return X.peak_trough(X.hourly_profile(_panel(spark, sf)))


@query("daytype_stats")
def q_daytype_stats(spark, sf):
    """Q-daytype: mean, std, min, max by day type (P10)."""
    return X.daytype_stats(_panel(spark, sf))


@query("daytype_diff")
def q_daytype_diff(spark, sf):
    """Q-daytype: weekday minus weekend mean and its percentage."""
    return X.daytype_difference(_panel(spark, sf))


@query("box_stats")
def q_box_stats(spark, sf):
    """Box-plot statistics by series and day type."""
    p = _panel(spark, sf).withColumn("day_type", tc.day_type("is_weekend"))
    return A.box_stats(p, [KEY, "day_type"], PRICE)


@query("rolling")
def q_rolling(spark, sf):
    """Centred 24-hour rolling mean and std (halo buckets)."""
    return S.rolling_stats(_panel(spark, sf).select(KEY, TS, PRICE), [KEY], TS, PRICE, 24, True)


@query("rolling_observed")
def q_rolling_observed(spark, sf):
    """W1 on the observed (gappy) series: frames of 24 rows, not of 24 hours."""
    observed = SI.hourly_prices(spark, sf).filter(F.col(PRICE).isNotNull()).filter(F.dayofmonth(TS) % 5 != 2)
    return S.rolling_rows(observed.select(KEY, TS, PRICE), [KEY], TS, PRICE, 24, True)


@query("coverage_islands")
def q_coverage_islands(spark, sf):
    """Every unbroken stretch of every series, and those in which all series are present."""
    seen = SI.hourly_prices(spark, sf).filter(F.col(PRICE).isNotNull()).select(KEY, TS)
    each = S.islands(seen, [KEY], TS)
    joint = S.joint_islands(each, [KEY]).withColumn(KEY, F.lit("(all)"))
    return each.unionByName(joint)


@query("local_stamps")
def q_local_stamps(spark, sf):
    """Plain local stamps over both clock changes to UTC, with a status per row."""
    return tx.resolve_local_stamps(SI.local_stamps(spark, sf), [KEY, "feed"], "line", "stamp")


@query("key_shift")
def q_key_shift(spark, sf):
    """Q-merge-diag: the shift in hours between two key sets, per series and week."""
    left, right = SI.shifted_keys(spark, sf)
    return J.key_shift(left, right, [KEY], period="week")


@query("market_clearing")
def q_market_clearing(spark, sf):
    """Q-curve: clearing price and quantity per day, where the two step curves meet."""
    return X.market_clearing(SI.sided_bids(spark, sf), [TS], "bid_type")


@query("changes")
def q_changes(spark, sf):
    """First difference and forward-filled percent change."""
    return S.changes(_panel(spark, sf).select(KEY, TS, PRICE), [KEY], TS, PRICE, fill=True)


@query("volatility")
def q_volatility(spark, sf):
    """Q-vol: rolling-std summary, mean absolute change, largest rise / fall, CV."""
    return X.volatility(_panel(spark, sf))


@query("monthly_panel")
def q_monthly_panel(spark, sf):
    """Q-monthly / T11: month mean with start / end labels and policy share."""
    return X.monthly_profile(_panel(spark, sf))


@query("key_stats")
def q_key_stats(spark, sf):
    """A11 / Q-overview: mean, median, sample std, min, max per series."""
    return A.group_stats(_panel(spark, sf), [KEY], PRICE)


@query("daily_panel")
def q_daily_panel(spark, sf):
    """Q-daily: daily min, max and mean per series, empty days kept."""
    return tx.resample(_panel(spark, sf), [KEY], TS, PRICE, "day", ("min", "max", "mean"))


@query("daily_orders")
def q_daily_orders(spark, sf):
    """Daily mean, min, max of order prices, empty days kept."""
    o = SI.table(spark, sf, "orders")
    return tx.resample(o, [], "o_orderdate", "o_totalprice", "day", ("mean", "min", "max"))


@query("monthly_orders")
def q_monthly_orders(spark, sf):
    """Monthly mean per order priority, empty months kept."""
    o = SI.table(spark, sf, "orders")
    return tx.resample(o, ["o_orderpriority"], "o_orderdate", "o_totalprice", "month", ("mean",))


@query("histogram_phase")
def q_histogram_phase(spark, sf):
    """Q-hist / A20: 50-bin density histogram per series and phase."""
    p = tx.add_phase(_panel(spark, sf), mode="flag")
    return A.histogram(p, [KEY, "phase"], PRICE, bins=50, density=True)


@query("histogram_country")
def q_histogram_country(spark, sf):
    """Q-hist / A20: 30-bin count histogram per series."""
    return A.histogram(_panel(spark, sf), [KEY], PRICE, bins=30)


@query("describe_pair")
def q_describe_pair(spark, sf):
    """describe() of the two series side by side."""
    return R.describe_side_by_side(_panel(spark, sf), KEY, PRICE, [PA, PB])


@query("hourly_pair")
def q_hourly_pair(spark, sf):
    """Hourly mean and std of the two series side by side, 24-hour spine."""
    return R.hourly_side_by_side(_panel(spark, sf), KEY, PRICE, [PA, PB])


@query("quality")
def q_quality(spark, sf):
    """Q-quality: rows, range, series, missing prices and rate, phase counts."""
    return Q.quality_report(_panel(spark, sf)).select(
        "rows", "start", "end", "n_series", "missing_prices", "rows_during", "rows_pre", "missing_rate",
        "missing_warning", "any_missing", "max_price_during")


@query("expectations")
def q_expectations(spark, sf):
    """Rule checks in one aggregate pass."""
    return Q.expectations(_panel(spark, sf), Q.panel_rules(), {"price_present": 0.3})


def _raw_events(spark, sf):
    e = SI.table(spark, sf, "events")
    return e.select(tc.trunc_hour("ts").alias(TS), F.col("event_type").alias(KEY),
                    F.when(~F.isnan("value"), F.col("value")).alias("v"), "user_id")


@query("dup_keys")
def q_dup_keys(spark, sf):
    """(hour, series) keys of the raw events seen more than once."""
    return D.duplicate_keys(_raw_events(spark, sf), [TS, KEY])


@query("dup_report")
def q_dup_report(spark, sf):
    """Q-dups: occurrences, distinct values, range and sources per duplicated key (A18 re-aimed, A19)."""
    return Q.duplicate_report(_raw_events(spark, sf), [TS, KEY], "v", "user_id") \
        .select(TS, KEY, "occurrences", "n_distinct_values", "min_value", "max_value", "n_sources")


@query("load_prices")
def q_load_prices(spark, sf):
    """Q-load: wide stand-in files -> long prices, first file wins."""
    return load_wide_prices(SI.wide_prices(spark, sf))


@query("load_prices_market")
def q_load_prices_market(spark, sf):
    """Q-load with T14: hour labels are market-local (Europe/Madrid) hours, converted to true UTC."""
    return load_wide_prices(SI.wide_prices(spark, sf), mode="market")


@query("normalize_utc")
def q_normalize_utc(spark, sf):
    """Event times read as Europe/Madrid wall time and normalised to UTC."""
    e = SI.table(spark, sf, "events").select("event_id", "ts")
    return tx.normalize_to_utc(e, "ts", source_tz="Europe/Madrid")


@query("file_compare")
def q_file_compare(spark, sf):
    """Are the two landing files equal cell by cell (one-sided cells count as different)?"""
    long = R.wide_to_long(SI.wide_prices(spark, sf), ["DATE", "CONCEPT", "source"], value_col="v", drop_missing=False)
    return J.series_equal(long, ["DATE", "CONCEPT", "hour_index"], "v", F.col("source") == "part_a", F.col("source") == "part_b")


@query("pair_equal")
def q_pair_equal(spark, sf):
    """U3 on the panel: are the two series' prices identical hour by hour?"""
    p = _panel(spark, sf).select(KEY, TS, PRICE)
    return J.series_equal(p, [TS], PRICE, F.col(KEY) == PA, F.col(KEY) == PB)


@query("concept_alignment")
def q_concept_alignment(spark, sf):
    """Q-aligned / U3: do H1..H24 agree between the two concepts on each date of each file?"""
    w = SI.wide_prices(spark, sf).filter(F.col("CONCEPT").isin("PRICE_SP", "PRICE_PT"))
    long = R.wide_to_long(w, ["source", "DATE", "CONCEPT"], value_col="v", drop_missing=False)
    pair = long.groupBy("source", "DATE", "hour_index").agg(
        F.max(F.when(F.col("CONCEPT") == "PRICE_SP", F.col("v"))).alias("sp"),
        F.max(F.when(F.col("CONCEPT") == "PRICE_PT", F.col("v"))).alias("pt"))
    same = F.col("sp").eqNullSafe(F.col("pt"))
    return pair.groupBy("source", "DATE").agg(F.count(F.lit(1)).alias("n_hours"), F.bool_and(same).alias("equal"),
                                    F.count_if(~same).alias("n_different"))


@query("flows_panel")
def q_flows_panel(spark, sf):
    """R3 + J3: wide flow table on a gapless monthly axis (missing months as NULL rows)."""
    wide = SI.flows_wide(SI.flows_long(spark, sf))
    return tx.fill_period_gaps(wide, TS, unit="month")


@query("flow_phases")
def q_flow_phases(spark, sf):
    """Q-leak: mean flow of each directed pair before / during / after a window."""
    fl = tx.add_phase(SI.flows_long(spark, sf), mode="three", policy=("1996-01-01", "1997-12-31"))
    f = F.col("flow_mw")
    return fl.groupBy("country_from", "country_to").agg(
        *[F.avg(F.when(F.col("phase") == p, f)).alias(f"mean_{p}") for p in ("before", "during", "after")])


@query("year_matrix")
def q_year_matrix(spark, sf):
    """Year x priority matrix of means."""
    o = SI.table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    m = R.pivot_matrix(o, "year", "o_orderpriority", SI.ORDER_PRIORITIES, "o_totalprice", "avg", other="other")
    return m.select("year", *[F.col(f"`{p}`").alias(n) for p, n in zip(SI.ORDER_PRIORITIES, PRIORITY_NAMES)], "other")


@query("arrival_coverage")
def q_arrival_coverage(spark, sf):
    """Quarterly acquisition windows and the days that landed in each."""
    from ..sources.files import arrival_coverage
    o = SI.table(spark, sf, "orders")
    return arrival_coverage(o, "o_orderdate", months=3, start="1991-01-01", end="1999-12-31")


@query("hourly_range_avg")
def q_hourly_range_avg(spark, sf):
    """A4 + P2: mean and count per series over a half-open time range."""
    h = SI.hourly_prices(spark, sf, where=tc.time_range("ts", f"{SI.POLICY[0]} 00:00:00", _next_day(SI.POLICY[1])))
    return h.groupBy(KEY).agg(F.avg(PRICE).alias("mean"), F.count(F.lit(1)).alias("n"))


def _next_day(d: str) -> str:
    import datetime as dt
    return (dt.date.fromisoformat(d) + dt.timedelta(days=1)).isoformat() + " 00:00:00"


@query("summary")
def q_summary(spark, sf):
    """A1: rows, series, first and last timestamp."""
    return A.series_summary(SI.hourly_prices(spark, sf)).select("rows", "n_keys", "start", "end")


@query("series_days")
def q_series_days(spark, sf):
    """A2 / A3: rows, distinct days and NULL counts per series."""
    h = SI.hourly_prices(spark, sf)
    return A.null_counts(h, ["energy_mwh"], [KEY], extra=[A.distinct_days_expr(TS)]).select(KEY, "rows", "distinct_days", "energy_mwh_nulls")


@query("did")
def q_did(spark, sf):
    """Q-did: 2 x 2 difference in differences around the policy start."""
    return X.diff_in_diff(_panel(spark, sf), PA, PB, f"{SI.POLICY[0]} 00:00:00")


@query("supply_curve")
def q_supply_curve(spark, sf):
    """Q-curve: stepwise cumulative quantity by price per day and bid type."""
    return X.supply_curve(SI.bids(spark, sf), [TS, KEY, "bid_type"]).select(TS, KEY, "bid_type", PRICE, "quantity", "n_bids",
                                                          "cum_quantity")


@query("generation_shares")
def q_generation_shares(spark, sf):
    """Q-gen: quantity per technology and its share of the month."""
    li = SI.table(spark, sf, "lineitem").select(tc.trunc_month("l_shipdate").alias("month"),
                                                F.col("l_returnflag").alias("technology"), "l_quantity")
    return X.shares(li, ["month"], "technology", "l_quantity")


@query("generation_panel")
def q_generation_panel(spark, sf):
    """Q-gen: monthly generation by technology as columns (R3) on a gapless month axis."""
    li = SI.table(spark, sf, "lineitem").select(tc.trunc_month("l_shipdate").alias(TS),
                                                F.col("l_returnflag").alias("technology"), "l_quantity")
    wide = R.long_to_wide(li, [TS], ["technology"], SI.TECHNOLOGIES, "l_quantity", "sum", name_fmt="gen_{0}_mw", other="gen_other_mw")
    return tx.fill_period_gaps(wide, TS, unit="month")


@query("gaps")
def q_gaps(spark, sf):
    """Steps over 1.5 h in each observed series."""
    return S.gaps(SI.hourly_prices(spark, sf), [KEY], TS)


@query("nearest_weather")
def q_nearest_weather(spark, sf):
    """Nearest weather hour for panel rows without a weather match."""
    p = _panel(spark, sf).select(KEY, TS)
    w = SI.country_weather(spark, sf).select(KEY, TS)
    left = J.unmatched(p, w, [KEY, TS])
    return J.nearest_match(left, w, [KEY], TS)


@query("merge_diag")
def q_merge_diag(spark, sf):
    """Q-merge-diag: matched / unmatched rows and key overlap."""
    p = _panel(spark, sf).select(KEY, TS)
    w = SI.country_weather(spark, sf).select(KEY, TS)
    return Q.merge_diagnosis(p, w, [KEY, TS]).select("left_rows", "unmatched", "left_timestamps",
                                                     "right_timestamps", "overlap", "matched")


@query("key_alignment")
def q_key_alignment(spark, sf):
    """Do the two observed series cover the same hours?"""
    h = SI.hourly_prices(spark, sf)
    return J.key_alignment(h, [TS], F.col(KEY) == PA, F.col(KEY) == PB)


@query("table_profile")
def q_table_profile(spark, sf):
    """Columns and rows of each driver table."""
    from ..sources.catalog import table_profile
    names = ["events", "orders", "lineitem", "customer", "supplier", "part", "nation", "region"]
    return table_profile({n: SI.table(spark, sf, n) for n in names})


@query("value_counts")
def q_value_counts(spark, sf):
    """Rows per series."""
    return _panel(spark, sf).groupBy(KEY).agg(F.count(F.lit(1)).alias("rows"))


@query("series_balance")
def q_series_balance(spark, sf):
    """Equal row counts and aligned ranges across series."""
    return Q.series_balance(_panel(spark, sf))


@query("weather_season")
def q_weather_season(spark, sf):
    """Q-weather-season / A22: weather means per series and month."""
    w = SI.country_weather(spark, sf)
    return w.groupBy(KEY, F.month(TS).alias("month")).agg(F.avg("temperature_c").alias("temperature_c"),
                                                          F.avg("wind_speed_100m").alias("wind_speed_100m"))


@query("weather_weighted")
def q_weather_weighted(spark, sf):
    """A22 / J4 with weights: weighted mean of city weather per series and hour."""
    return SI.country_weather_weighted(spark, sf)


@query("wind_direction")
def q_wind_direction(spark, sf):
    """Weighted circular mean of city wind directions per series and hour, and how steady it is."""
    return SI.country_directions(spark, sf)


@query("first_rows")
def q_first_rows(spark, sf):
    """O3: first five hours of one series (explicit order + limit)."""
    return _panel(spark, sf).filter(F.col(KEY) == PA).orderBy(TS).limit(5).select(TS, PRICE)


@query("top_prices")
def q_top_prices(spark, sf):
    """O3 top-k: ten highest hourly prices, total order on ties."""
    h = SI.hourly_prices(spark, sf).filter(~is_missing(PRICE))
    return h.orderBy(F.col(PRICE).desc(), TS, KEY).limit(10).select(TS, KEY, PRICE)


@query("country_summary")
def q_country_summary(spark, sf):
    """A5: rows, first and last timestamp per series of the stored hourly table."""
    return SI.hourly_prices(spark, sf).groupBy(KEY).agg(
        F.count(F.lit(1)).alias("row_count"), F.min(TS).alias("start"), F.max(TS).alias("end"))


@query("day_head")
def q_day_head(spark, sf):
    """P3 + O3: first ten rows of one day ordered by (country, timestamp); the day
    filter is the pushable range form of ``date_trunc('day', ts) = d``."""
    h = SI.hourly_prices(spark, sf, where=tc.day_range("ts", SI.POLICY[0]))
    return h.orderBy(KEY, TS).limit(10).select(TS, KEY, PRICE)


@query("day_lookup")
def q_day_lookup(spark, sf):
    """P3 rewritten as a range (P2) + P12 key filter."""
    h = SI.hourly_prices(spark, sf, where=tc.day_range("ts", SI.POLICY[0]) & (F.col("event_type") == PA))
    return h.select(TS, KEY, PRICE)


@query("findings")
def q_findings(spark, sf):
    """Q-findings: one-row record of levels, coupling, hourly pattern, day type and volatility."""
    return X.findings(_panel(spark, sf), PA, PB)


def _state(kind: str, state: str | None) -> str:
    """Where a stream keeps its state: under the caller's name, else a new one, so that a run reads all that landed."""
    import uuid
    return f"wattgrid-{kind}-{state or uuid.uuid4().hex}"


@query("stream_hourly")
def q_stream_hourly(spark, sf, state=None):
    """Events as a stream of landed files, exact hourly totals whatever the batches, nothing late or open lost."""
    from ..streaming import ledger as L
    groups = T.StructType([T.StructField("window_start", T.TimestampNTZType()), T.StructField("event_type", T.StringType())])

    def hours(df):
        return df.filter(F.col("ts").isNotNull()).select(L.FILE, tc.trunc_hour("ts").alias("window_start"), "event_type", "value")
    out = L.follow_totals(spark, f"{sf}/events.parquet", hours, groups, "value", _state("hourly", state))
    return out.select("window_start", tc.add_hours("window_start", 1).alias("window_end"), "event_type", "n", "total", "mean")


@query("stream_dedupe")
def q_stream_dedupe(spark, sf, state=None):
    """Each (hour, series) key of a stream of event files once, whatever the batches and however late."""
    from ..streaming import ledger as L
    keys = T.StructType([T.StructField(TS, T.TimestampNTZType()), T.StructField(KEY, T.StringType())])

    def hours(df):
        return df.filter(F.col("ts").isNotNull()).select(L.FILE, tc.trunc_hour("ts").alias(TS), F.col("event_type").alias(KEY))
    return L.follow_first_wins(spark, f"{sf}/events.parquet", hours, keys, [TS, KEY], [], _state("dedupe", state))


def _follow_prices(spark, landing, name):
    """First-wins prices of the wide files at ``landing``; the folder's name is the source."""
    from ..schemas import PRICES_DAY_AHEAD
    from ..streaming import ledger as L

    def rows(df):
        named = df.withColumn("source", F.regexp_extract(L.FILE, r"([^/]+)/[^/]+$", 1))
        return wide_price_rows(named, carry=(L.FILE,)).withColumn("energy_mwh", F.lit(None).cast("double"))
    return L.follow_first_wins(spark, landing, rows, _with_source(PRICES_DAY_AHEAD), [TS, KEY], ["source", PRICE], name)


@query("stream_load_prices")
def q_stream_load_prices(spark, sf, state=None):
    """Two wide 'files' land one after the other; first write wins on key by source."""
    from ..session import scratch_path
    name = _state("landing", state)
    landing = scratch_path(spark, name + "-files")
    wide = SI.wide_prices(spark, sf)
    for part in ("part_a", "part_b"):
        wide.filter(F.col("source") == part).drop("source").write.mode("overwrite").parquet(f"{landing}/{part}")
        out = _follow_prices(spark, landing, name)
    return out.select(TS, KEY, PRICE, "source")


@query("stream_replaced_files")
def q_stream_replaced_files(spark, sf, state=None):
    """The first file lands with wrong prices and an extra one lands too; later the first is replaced and the
    extra one vanishes. What is stored follows: the answer is that of a fresh load."""
    from ..session import scratch_path
    name = _state("replaced", state)
    landing = scratch_path(spark, name + "-files")
    wide = SI.wide_prices(spark, sf)
    a, b = (wide.filter(F.col("source") == part).drop("source") for part in ("part_a", "part_b"))
    wrong = a.select("DATE", "CONCEPT", *[(F.col(f"H{i}") * 3 - 7).alias(f"H{i}") for i in range(1, 25)])
    for df, folder in ((wrong, "part_a"), (b, "part_b"), (wrong, "part_0")):
        df.write.mode("overwrite").parquet(f"{landing}/{folder}")
    _follow_prices(spark, landing, name)
    a.write.mode("overwrite").parquet(f"{landing}/part_a")
    a.limit(0).write.mode("overwrite").parquet(f"{landing}/part_0")
    return _follow_prices(spark, landing, name).select(TS, KEY, PRICE, "source")


@query("stream_corrections")
def q_stream_corrections(spark, sf, state=None):
    """Events land in three parts, the last one late by up to the whole range: hourly windows close as the
    watermark passes, late rows go to corrections, and both together are exact."""
    from ..session import scratch_path
    from ..streaming import corrections as C
    name = _state("corrections", state)
    landing = scratch_path(spark, name + "-files")
    e = SI.table(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    split, late = F.lit(SI.POLICY[0]).cast("timestamp_ntz"), F.col("event_id") % 5 == 0
    keys = T.StructType([T.StructField("event_type", T.StringType())])
    windows = C.CorrectedWindows(spark, name, "ts", keys, "value", delay_hours=SI.DELAY_HOURS)
    for part, rows in (("1", ~late & (F.col("ts") < split)), ("2", ~late & ~(F.col("ts") < split)), ("3", late)):
        e.filter(rows).drop("event_id").write.mode("overwrite").parquet(f"{landing}/part_{part}")
        windows.run(C.file_stream(spark, f"{landing}/*", e.drop("event_id").schema))
    return windows.totals()


@query("load_files")
def q_load_files(spark, sf):
    """Wide files with dates of different types are read, loaded first-wins into a versioned
    table in two batches (the second again in full), and one hour of the day is deleted in place."""
    import uuid
    from ..schemas import PRICES_DAY_AHEAD
    from ..session import scratch_path
    from ..sources import files
    from ..sources.versioned import VersionedTable
    base = scratch_path(spark, f"files-{uuid.uuid4().hex}")
    paths = SI.land_wide_files(spark, sf, f"{base}/landing")
    table = VersionedTable(spark, f"{base}/prices", _with_source(PRICES_DAY_AHEAD), TS)

    def load(some):
        long = load_wide_prices(files.read_wide_prices(spark, some))
        return long.withColumn("source", F.regexp_extract("source", "(part_[ab])", 1))
    table.overwrite(load(paths[:1]))
    for some in (paths[1:], paths):
        table.append_ignore(load(some), [TS, KEY], ["source", PRICE])
    table.delete_where(F.hour(TS) == 3)
    return table.read().select(TS, KEY, PRICE, "source")


@query("file_inventory")
def q_file_inventory(spark, sf):
    """What landed per folder: rows, dates and range, columns renamed to the table's."""
    import uuid
    from ..session import scratch_path
    from ..sources import files
    paths = SI.land_wide_files(spark, sf, scratch_path(spark, f"inventory-{uuid.uuid4().hex}"))
    out = None
    for path in paths:
        inv = files.file_inventory(spark, path)
        days = files.read_wide_prices(spark, path).agg(F.min("DATE").alias("first_day"), F.max("DATE").alias("last_day"), F.count_distinct("DATE").alias("dates"))
        files_of = inv.agg(F.sum("rows").alias("rows"), F.count_if(F.col("file_size") <= 0).alias("no_bytes"))
        one = combine_single_rows([files_of, days]).select(F.lit(path.rsplit("/", 1)[1]).alias("folder"), "rows", "no_bytes", "first_day", "last_day", "dates")
        out = one if out is None else out.unionByName(one)
    return out


@query("panel_flows")
def q_panel_flows(spark, sf):
    """Q-panel with flows (J3): every panel hour carries the hour's flow columns."""
    from ..operators import panel as P
    p = P.build_panel(SI.spine(spark, sf), SI.hourly_prices(spark, sf), None, SI.hourly_flows_wide(spark, sf), policy=SI.POLICY)
    return p.select(TS, KEY, PRICE, *[f"{a}_to_{b}_mw" for a, b in SI.HOURLY_FLOW_PAIRS], "other_mw")


@query("duration_phase")
def q_duration_phase(spark, sf):
    """Q-duration before / during / after the policy: step tables per series and phase."""
    p = tx.add_phase(_panel(spark, sf), mode="three", policy=SI.POLICY)
    return S.duration_steps(p, [KEY, "phase"], PRICE)


@query("monthly_gap")
def q_monthly_gap(spark, sf):
    """Monthly means of the two series and their gap."""
    k, v = F.col(KEY), F.col(PRICE)
    m = _panel(spark, sf).filter(k.isin(PA, PB)).groupBy(tc.trunc_month(TS).alias("month")).agg(
        F.avg(F.when(k == PA, v)).alias("mean_a"), F.avg(F.when(k == PB, v)).alias("mean_b"))
    return m.withColumn("gap", F.col("mean_a") - F.col("mean_b"))


@query("dup_evidence")
def q_dup_evidence(spark, sf):
    """Q-dups / W7 / A18: every source row of a duplicated (hour, series) key, with its value."""
    return D.duplicated_rows(_raw_events(spark, sf), [TS, KEY]).select(TS, KEY, "user_id", "v")


@query("dst_clean")
def q_dst_clean(spark, sf):
    """One row kept per hour and series of the raw events, the rest of its check aside."""
    return Q.handle_dst_transitions(_raw_events(spark, sf), [KEY], TS, ["user_id", "v"])["clean"].select(TS, KEY, "user_id", "v")


@query("split_at_start")
def q_split_at_start(spark, sf):
    """Rows and mean per series before and from the policy's start."""
    p = tx.add_phase(_panel(spark, sf), mode="start", policy=SI.POLICY)
    return p.groupBy(KEY, "phase").agg(F.count(F.lit(1)).alias("rows"), F.avg(PRICE).alias("mean"))


@query("series_by_mean")
def q_series_by_mean(spark, sf):
    """O2: the three series with the lowest mean, ascending."""
    m = _panel(spark, sf).groupBy(KEY).agg(F.avg(PRICE).alias("mean"))
    return m.orderBy(F.col("mean").asc_nulls_last(), KEY).limit(3)


@query("day_equal")
def q_day_equal(spark, sf):
    """Rows of one calendar day by equality of dates."""
    h = SI.hourly_prices(spark, sf)
    return h.filter(F.to_date(TS) == F.lit(SI.POLICY[0]).cast("date")).groupBy(KEY).agg(F.count(F.lit(1)).alias("rows"))


@query("rule_checks")
def q_rule_checks(spark, sf):
    """E1 (wide band) E8: possible prices, whole hours, code format and required columns."""
    h = SI.hourly_prices(spark, sf)
    return Q.expectations(h, Q.wide_price_rules() | Q.key_rules(TS, KEY, (PRICE, "energy_mwh")))


@query("weather_bounds")
def q_weather_bounds(spark, sf):
    """Mean weather per series within plausible bounds."""
    return Q.mean_bounds(SI.country_weather(spark, sf), {"temperature_c": (-20.0, 50.0), "wind_speed_100m": (0.0, 50.0)}, [KEY])


@query("hourly_steps")
def q_hourly_steps(spark, sf):
    """Steps that are not one hour, in the panel (none) and in the observed hours."""
    both = _panel(spark, sf).select(F.lit("panel").alias("what"), KEY, TS).unionByName(SI.hourly_prices(spark, sf).select(F.lit("observed").alias("what"), KEY, TS))
    return S.step_check(both, ["what", KEY], TS)


@query("wide_schema")
def q_wide_schema(spark, sf):
    """The wide table has its date, concept and 24 hour columns; and how many rows carry them."""
    w = SI.wide_prices(spark, sf)
    ok = Q.wide_schema_check(w)
    return w.agg(F.count(F.lit(1)).alias("rows")).select("rows", *[F.lit(v).alias(k) for k, v in ok.items()])


def _with_source(schema):
    return T.StructType(list(schema.fields) + [T.StructField("source", T.StringType())])


def queries() -> dict[str, Query]:
    return dict(QUERIES)
