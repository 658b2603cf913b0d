"""DuckDB SQL twins of the registered queries (the correctness oracle).

Shared CTEs mirror ``plans.standins``; each query's final SELECT rounds DOUBLE
columns to 6 digits and casts integers to BIGINT, as ``registry.finish`` does.
"""
from __future__ import annotations

from .standins import (AUTUMN_DAYS, DELAY_HOURS, SHIFT_FROM, SPRING_DAYS, TECHNOLOGIES, CITY_TO_SERIES, CITY_WEIGHTS, CONCEPTS, FILE_A_LAST_DAY, FILE_B_FIRST_DAY, FLOW_PAIRS, PAIR,
                       POLICY, SERIES_TO_CONCEPT)

A, B = PAIR
P0 = f"TIMESTAMP '{POLICY[0]} 00:00:00'"
P1 = f"TIMESTAMP '{POLICY[1]} 23:59:59'"
NN = "CASE WHEN isnan(value) THEN NULL ELSE value END"


def rounded(expr: str) -> str:
    """Same float operations as ``functions.numeric.round_even``."""
    return f"round_even(round_even(({expr}) * 1000000000.0, 0) / 1000000000.0 * 1000000.0, 0) / 1000000.0"


def r(expr: str, alias: str) -> str:
    return f"{rounded(expr)} AS {alias}"


CTE = {}
CTE["hourly"] = f"""hourly AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp", event_type AS country,
         avg({NN}) AS price_eur_mwh, sum({NN}) AS energy_mwh
  FROM events WHERE ts IS NOT NULL AND event_type IS NOT NULL GROUP BY 1, 2)"""
CTE["spine"] = """rng AS (SELECT min(CAST("timestamp" AS DATE)) AS d0, max(CAST("timestamp" AS DATE)) AS d1 FROM hourly),
hours AS (SELECT unnest(generate_series(CAST(d0 AS TIMESTAMP), CAST(d1 AS TIMESTAMP) + INTERVAL 23 HOUR,
                                       INTERVAL 1 HOUR)) AS "timestamp" FROM rng),
keys AS (SELECT DISTINCT country FROM hourly),
spine AS (SELECT h."timestamp", k.country FROM hours h CROSS JOIN keys k)"""
_dim_rows = ", ".join(f"('{k}', '{v}')" for k, v in CITY_TO_SERIES.items())
CTE["weather"] = f"""city AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp", 'L' || CAST(user_id % 7 AS VARCHAR) AS location,
         avg({NN}) AS temperature_c, avg(CAST(user_id % 50 AS DOUBLE)) AS wind_speed_100m
  FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL GROUP BY 1, 2),
dim AS (SELECT * FROM (VALUES {_dim_rows}) t(location, country)),
weather AS (SELECT c."timestamp", d.country, avg(c.temperature_c) AS temperature_c,
                   avg(c.wind_speed_100m) AS wind_speed_100m
            FROM city c JOIN dim d ON c.location = d.location GROUP BY 1, 2)"""
CTE["panel"] = f"""panel AS (
  SELECT s."timestamp", s.country, h.price_eur_mwh, h.energy_mwh, w.temperature_c, w.wind_speed_100m,
         hour(s."timestamp") AS hour, isodow(s."timestamp") - 1 AS day_of_week, month(s."timestamp") AS month,
         year(s."timestamp") AS year, quarter(s."timestamp") AS quarter, dayofyear(s."timestamp") AS day_of_year,
         isodow(s."timestamp") >= 6 AS is_weekend,
         s."timestamp" BETWEEN {P0} AND {P1} AS in_policy
  FROM spine s
  LEFT JOIN hourly h ON h."timestamp" = s."timestamp" AND h.country = s.country
  LEFT JOIN weather w ON w."timestamp" = s."timestamp" AND w.country = s.country)"""


def with_panel(body: str, *extra: str) -> str:
    ctes = [CTE["hourly"], CTE["spine"], CTE["weather"], CTE["panel"], *extra]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def with_hourly(body: str, *extra: str) -> str:
    return "WITH " + ",\n".join([CTE["hourly"], *extra]) + "\n" + body


def stats_cols(v: str, with_median: bool = True) -> str:
    med = f", {r(f'median({v})', 'median')}" if with_median else ""
    return (f"count({v}) AS n, {r(f'avg({v})', 'mean')}{med}, {r(f'stddev_samp({v})', 'std')}, "
            f"{r(f'min({v})', 'min')}, {r(f'max({v})', 'max')}")


SQL: dict[str, str] = {}

SQL["panel"] = with_panel(f"""SELECT "timestamp", country, {r('price_eur_mwh', 'price_eur_mwh')},
  {r('energy_mwh', 'energy_mwh')}, {r('temperature_c', 'temperature_c')}, {r('wind_speed_100m', 'wind_speed_100m')},
  CAST(hour AS BIGINT) AS hour, CAST(day_of_week AS BIGINT) AS day_of_week, CAST(month AS BIGINT) AS month,
  CAST(year AS BIGINT) AS year, CAST(quarter AS BIGINT) AS quarter, CAST(day_of_year AS BIGINT) AS day_of_year,
  is_weekend, in_policy FROM panel""")

_imp = []
for name, cond in (("pre", "NOT in_policy"), ("during", "in_policy")):
    v = "price_eur_mwh"
    _imp.append(f"""count(*) FILTER (WHERE {cond}) AS rows_{name}, count({v}) FILTER (WHERE {cond}) AS n_{name},
    avg({v}) FILTER (WHERE {cond}) AS mean_{name}, median({v}) FILTER (WHERE {cond}) AS median_{name},
    stddev_samp({v}) FILTER (WHERE {cond}) AS std_{name}, min({v}) FILTER (WHERE {cond}) AS min_{name},
    max({v}) FILTER (WHERE {cond}) AS max_{name},
    CAST(CAST(min("timestamp") FILTER (WHERE {cond}) AS DATE) AS TIMESTAMP) AS first_{name},
    CAST(CAST(max("timestamp") FILTER (WHERE {cond}) AS DATE) AS TIMESTAMP) AS last_{name}""")
_imp_out = []
for name in ("pre", "during"):
    _imp_out.append(f"""rows_{name}, n_{name}, {r(f'mean_{name}', f'mean_{name}')}, {r(f'median_{name}', f'median_{name}')},
    {r(f'std_{name}', f'std_{name}')}, {r(f'min_{name}', f'min_{name}')}, {r(f'max_{name}', f'max_{name}')},
    first_{name}, last_{name}""")
SQL["policy_impact"] = with_panel(f"""SELECT country, {', '.join(_imp_out)},
  {r('mean_during - mean_pre', 'mean_diff')},
  {r('(mean_during - mean_pre) / NULLIF(mean_pre, 0) * 100', 'pct_change')},
  CASE WHEN mean_during - mean_pre < 0 THEN 'decrease' WHEN mean_during - mean_pre >= 0 THEN 'increase' END AS direction,
  {r('CASE WHEN mean_during - mean_pre < 0 THEN abs(mean_during - mean_pre) * rows_during END', 'savings')}
FROM (SELECT country, {', '.join(_imp)} FROM panel GROUP BY country) t""")


def _phase_stats_sql(phase_expr: str) -> str:
    v = "price_eur_mwh"
    return with_panel(f"""SELECT country, phase, count(*) AS rows, {stats_cols(v)},
  {r(f'quantile_cont({v}, 0.1)', 'p10')}, {r(f'quantile_cont({v}, 0.9)', 'p90')}
FROM (SELECT *, {phase_expr} AS phase FROM panel) t GROUP BY country, phase""")


SQL["stats5"] = _phase_stats_sql("CASE WHEN in_policy THEN 'during' WHEN NOT in_policy THEN 'pre' END")
SQL["phase_stats3"] = _phase_stats_sql(
    f"""CASE WHEN "timestamp" < {P0} THEN 'before' WHEN "timestamp" <= {P1} THEN 'during'
         WHEN "timestamp" IS NOT NULL THEN 'after' END""")

CTE["pair"] = f"""pair AS (
  SELECT "timestamp", max(CASE WHEN country = '{A}' THEN price_eur_mwh END) AS a,
         max(CASE WHEN country = '{B}' THEN price_eur_mwh END) AS b
  FROM panel WHERE country IN ('{A}', '{B}') GROUP BY "timestamp"
  HAVING max(CASE WHEN country = '{A}' THEN 1 ELSE 0 END) = 1 AND max(CASE WHEN country = '{B}' THEN 1 ELSE 0 END) = 1)"""
SQL["coupling"] = with_panel(f"""SELECT n_hours, n_pairs, {r('correlation', 'correlation')}, {r('mean_diff', 'mean_diff')},
  {r('max_abs_diff', 'max_abs_diff')}, identical_hours,
  {r('CAST(identical_hours AS DOUBLE) / NULLIF(n_hours, 0)', 'identical_share')},
  CAST(identical_hours AS DOUBLE) / NULLIF(n_hours, 0) > 0.95 AS highly_coupled,
  CASE WHEN correlation > 0.95 THEN 'Strongly coupled market' WHEN correlation > 0.80 THEN 'Moderately coupled market'
       ELSE 'Weakly coupled market' END AS coupling_label
FROM (SELECT count(*) AS n_hours, count(a - b) AS n_pairs, corr(a, b) AS correlation, avg(a - b) AS mean_diff,
             max(abs(a - b)) AS max_abs_diff, count(*) FILTER (WHERE abs(a - b) < 0.01) AS identical_hours FROM pair) t""",
                              CTE["pair"])
SQL["divergence"] = with_panel(f"""SELECT CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS month,
  CAST(hour("timestamp") AS BIGINT) AS hour, count(*) AS n_hours, count(abs(a - b)) AS n_both,
  count(*) FILTER (WHERE abs(a - b) >= 0.01) AS n_diverged,
  {r('CAST(count(*) FILTER (WHERE abs(a - b) >= 0.01) AS DOUBLE) / NULLIF(count(abs(a - b)), 0)', 'share_diverged')}
FROM pair GROUP BY 1, 2""", CTE["pair"])

SQL["duration_steps"] = with_panel(f"""SELECT country, {r('price_eur_mwh', 'price_eur_mwh')}, n_rows, rank_first,
  rank_first + n_rows - 1 AS rank_last, n_total,
  {r('CAST(rank_first AS DOUBLE) * 100.0 / n_total', 'position_first')},
  {r('CAST(rank_first + n_rows - 1 AS DOUBLE) * 100.0 / n_total', 'position_last')}
FROM (SELECT country, price_eur_mwh, n_rows,
        CAST(coalesce(sum(n_rows) OVER (PARTITION BY country ORDER BY price_eur_mwh DESC NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rank_first,
        CAST(sum(n_rows) OVER (PARTITION BY country) AS BIGINT) AS n_total
      FROM (SELECT country, price_eur_mwh, count(*) AS n_rows FROM panel GROUP BY 1, 2) f) t""")
CTE["ranked"] = """ranked AS (
  SELECT country, price_eur_mwh,
         row_number() OVER (PARTITION BY country ORDER BY price_eur_mwh DESC NULLS LAST) - 1 AS i,
         count(*) OVER (PARTITION BY country) AS n
  FROM panel)"""
SQL["duration_markers"] = with_panel("SELECT country, max(n) AS n_total, " + ", ".join(
    r(f"max(CASE WHEN i = ({p} * n) // 100 THEN price_eur_mwh END)", f"p{p}") for p in (10, 25, 50, 75, 90))
    + " FROM ranked GROUP BY country", CTE["ranked"])
SQL["duration_curve"] = with_panel(f"""SELECT country, i AS rank, {r('CAST(i AS DOUBLE) * 100.0 / n', 'position')},
  {r('price_eur_mwh', 'price_eur_mwh')} FROM ranked""", CTE["ranked"])


def _profile_sql(extra_keys: str = "", src: str = "panel") -> str:
    v = "price_eur_mwh"
    ek = f"{extra_keys}, " if extra_keys else ""
    return f"""SELECT country, {ek}CAST(hour AS BIGINT) AS hour, count({v}) AS n, {r(f'avg({v})', 'mean')},
  {r(f'stddev_samp({v})', 'std')}, {r(f'avg({v}) - stddev_samp({v})', 'band_lo')},
  {r(f'avg({v}) + stddev_samp({v})', 'band_hi')} FROM {src} GROUP BY country, {ek}hour"""


SQL["hourly_profile"] = with_panel(_profile_sql())
SQL["daytype_hourly"] = with_panel(_profile_sql("is_weekend"))
CTE["phased"] = f"""phased AS (SELECT *, CASE WHEN "timestamp" < {P0} THEN 'before' WHEN "timestamp" <= {P1} THEN 'during'
  WHEN "timestamp" IS NOT NULL THEN 'after' END AS phase FROM panel)"""
SQL["phase_hourly"] = with_panel(_profile_sql("phase", "phased"), CTE["phased"])
SQL["peak_trough"] = with_panel(f"""SELECT country,
  CAST(max(CASE WHEN rn_max = 1 THEN hour END) AS BIGINT) AS peak_hour, {r('max(mean)', 'peak_mean')},
  CAST(max(CASE WHEN rn_min = 1 THEN hour END) AS BIGINT) AS trough_hour, {r('min(mean)', 'trough_mean')},
  {r('max(mean) - min(mean)', 'spread')}
FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY mean DESC, hour) AS rn_max,
             row_number() OVER (PARTITION BY country ORDER BY mean ASC, hour) AS rn_min
      FROM (SELECT country, hour, avg(price_eur_mwh) AS mean FROM panel GROUP BY 1, 2) p
      WHERE mean IS NOT NULL) t GROUP BY country""")

CTE["daytyped"] = """daytyped AS (SELECT *, CASE WHEN is_weekend THEN 'Weekend' WHEN NOT is_weekend THEN 'Weekday' END
  AS day_type FROM panel)"""
SQL["daytype_stats"] = with_panel(f"""SELECT country, day_type, {stats_cols('price_eur_mwh', False)}
FROM daytyped WHERE day_type IS NOT NULL GROUP BY 1, 2""", CTE["daytyped"])
SQL["daytype_diff"] = with_panel(f"""SELECT country, {r('wd', 'weekday_mean')}, {r('we', 'weekend_mean')},
  {r('wd - we', 'difference')}, {r('(wd - we) / NULLIF(wd, 0) * 100', 'pct_difference')}
FROM (SELECT country, avg(CASE WHEN NOT is_weekend THEN price_eur_mwh END) AS wd,
             avg(CASE WHEN is_weekend THEN price_eur_mwh END) AS we FROM panel GROUP BY 1) t""")
SQL["box_stats"] = with_panel(f"""SELECT q.country, q.day_type, {r('q1', 'q1')}, {r('median', 'median')}, {r('q3', 'q3')},
  {r('iqr', 'iqr')}, {r('lo_fence', 'lo_fence')}, {r('hi_fence', 'hi_fence')},
  {r('min(CASE WHEN v >= lo_fence AND v <= hi_fence THEN v END)', 'whisker_lo')},
  {r('max(CASE WHEN v >= lo_fence AND v <= hi_fence THEN v END)', 'whisker_hi')},
  count(*) FILTER (WHERE NOT (v >= lo_fence AND v <= hi_fence)) AS n_outliers, count(*) AS n
FROM (SELECT country, day_type, q1, median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_fence,
             q3 + 1.5 * (q3 - q1) AS hi_fence
      FROM (SELECT country, day_type, quantile_cont(price_eur_mwh, 0.25) AS q1,
                   quantile_cont(price_eur_mwh, 0.5) AS median, quantile_cont(price_eur_mwh, 0.75) AS q3
            FROM daytyped WHERE price_eur_mwh IS NOT NULL GROUP BY 1, 2) a) q
JOIN (SELECT country, day_type, price_eur_mwh AS v FROM daytyped WHERE price_eur_mwh IS NOT NULL) d
  ON d.country = q.country AND d.day_type = q.day_type
GROUP BY q.country, q.day_type, q1, median, q3, iqr, lo_fence, hi_fence""", CTE["daytyped"])

CTE["rolled"] = """rolled AS (
  SELECT country, "timestamp", price_eur_mwh,
         CASE WHEN count(price_eur_mwh) OVER w = 24 THEN avg(price_eur_mwh) OVER w END AS rolling_mean,
         CASE WHEN count(price_eur_mwh) OVER w = 24 THEN stddev_samp(price_eur_mwh) OVER w END AS rolling_std
  FROM panel WINDOW w AS (PARTITION BY country ORDER BY "timestamp" ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING))"""
SQL["rolling"] = with_panel(f"""SELECT country, "timestamp", {r('price_eur_mwh', 'price_eur_mwh')},
  {r('rolling_mean', 'rolling_mean')}, {r('rolling_std', 'rolling_std')},
  {r('rolling_mean - rolling_std', 'rolling_lo')}, {r('rolling_mean + rolling_std', 'rolling_hi')} FROM rolled""",
                            CTE["rolled"])
CTE["changed"] = """changed AS (
  SELECT country, "timestamp", price_eur_mwh,
         price_eur_mwh - lag(price_eur_mwh) OVER (PARTITION BY country ORDER BY "timestamp") AS diff,
         CASE WHEN f IS NOT NULL THEN (f / NULLIF(fp, 0) - 1) * 100 END AS pct_change
  FROM (SELECT *, last_value(price_eur_mwh IGNORE NULLS) OVER (PARTITION BY country ORDER BY "timestamp"
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f,
                  last_value(price_eur_mwh IGNORE NULLS) OVER (PARTITION BY country ORDER BY "timestamp"
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fp FROM panel) t)"""
SQL["changes"] = with_panel(f"""SELECT country, "timestamp", {r('price_eur_mwh', 'price_eur_mwh')},
  {r('diff', 'diff')}, {r('pct_change', 'pct_change')} FROM changed""", CTE["changed"])
SQL["volatility"] = with_panel(f"""SELECT r.country, {r('avg(rolling_std)', 'mean_rolling_std')},
  {r('max(rolling_std)', 'max_rolling_std')}, {r('avg(abs(diff))', 'mean_abs_change')},
  {r('max(diff)', 'largest_rise')}, {r('min(diff)', 'largest_fall')}, {r('stddev_samp(r.price_eur_mwh)', 'std')},
  {r('stddev_samp(r.price_eur_mwh) / NULLIF(avg(r.price_eur_mwh), 0)', 'cv')}
FROM rolled r JOIN changed c ON r.country = c.country AND r."timestamp" = c."timestamp" GROUP BY r.country""",
                               CTE["rolled"], CTE["changed"])


def _resample_sql(src: str, keys: list[str], ts: str, v: str, unit: str, aggs: list[str]) -> str:
    k = ", ".join(keys)
    kc = k + ", " if keys else ""
    per = f"CAST({ts} AS DATE)" if unit == "day" else f"CAST(date_trunc('month', {ts}) AS DATE)"
    step = "INTERVAL 1 DAY" if unit == "day" else "INTERVAL 1 MONTH"
    fns = {"mean": "avg", "min": "min", "max": "max", "sum": "sum"}
    agg_in = ", ".join(f"{fns[a]}({v}) AS {a}" for a in aggs)
    agg_out = ", ".join(r(f"g.{a}", a) for a in aggs)
    end = "CAST(s.p AS TIMESTAMP)" if unit == "day" else "CAST(last_day(s.p) AS TIMESTAMP)"
    on = " AND ".join([f"g.{x} = s.{x}" for x in keys] + ["g.p = s.p"])
    skeys = ", ".join(f"s.{x}" for x in keys)
    skc = skeys + ", " if keys else ""
    return f"""g AS (SELECT {kc}{per} AS p, count({v}) AS n, {agg_in} FROM {src} GROUP BY {kc}p),
b AS (SELECT {kc}min(p) AS lo, max(p) AS hi FROM g {'GROUP BY ' + k if keys else ''}),
s AS (SELECT {kc}CAST(unnest(generate_series(lo, hi, {step})) AS DATE) AS p FROM b)
SELECT {skc}CAST(s.p AS TIMESTAMP) AS period_start, {end} AS period_end, coalesce(g.n, 0) AS n, {agg_out}
FROM s LEFT JOIN g ON {on}"""


_mp = _resample_sql("panel", ["country"], '"timestamp"', "price_eur_mwh", "month", ["mean"])
SQL["monthly_panel"] = with_panel(f"""SELECT m.*, {r('sh.policy_share', 'policy_share')}, sh.rows FROM (
{_mp.split(chr(10) + 'SELECT ', 1)[1].join(['SELECT ', ''])}) m
LEFT JOIN (SELECT country, CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS period_start,
                  avg(CAST(in_policy AS DOUBLE)) AS policy_share, count(*) AS rows FROM panel GROUP BY 1, 2) sh
  ON sh.country = m.country AND sh.period_start = m.period_start""", _mp.split("\nSELECT ", 1)[0])
SQL["daily_orders"] = "WITH " + _resample_sql("orders", [], "o_orderdate", "o_totalprice", "day", ["mean", "min", "max"])
SQL["monthly_orders"] = "WITH " + _resample_sql("orders", ["o_orderpriority"], "o_orderdate", "o_totalprice",
                                                "month", ["mean"])


def _hist_sql(group_expr: dict[str, str], bins: int, density: bool) -> str:
    gk = ", ".join(group_expr)
    gsel = ", ".join(f"{e} AS {n}" for n, e in group_expr.items())
    using = ", ".join(group_expr)
    dens = f", {r(f'coalesce(c.cnt, 0) / (sp.n * ((sp.hi - sp.lo) / {bins}))', 'density')}" if density else ""
    on = " AND ".join(f"c.{x} = sp.{x}" for x in group_expr) + " AND c.bin = sp.bin"
    spk = ", ".join(f"sp.{x}" for x in group_expr)
    ctes = f"""d AS (SELECT {gsel}, price_eur_mwh AS v FROM panel WHERE price_eur_mwh IS NOT NULL),
rg AS (SELECT {gk}, count(v) AS n, CASE WHEN max(v) > min(v) THEN min(v) ELSE min(v) - 0.5 END AS lo,
              CASE WHEN max(v) > min(v) THEN max(v) ELSE max(v) + 0.5 END AS hi FROM d GROUP BY {gk}),
c AS (SELECT {', '.join('d.' + x for x in group_expr)},
             CAST(least(floor((d.v - rg.lo) * {bins} / (rg.hi - rg.lo)), {bins - 1}) AS BIGINT) AS bin,
             count(*) AS cnt FROM d JOIN rg USING ({using}) GROUP BY ALL),
sp AS (SELECT rg.*, b.range AS bin FROM rg CROSS JOIN range(0, {bins}) b)"""
    body = f"""SELECT {spk}, sp.bin, {r(f'sp.lo + sp.bin * ((sp.hi - sp.lo) / {bins})', 'bin_lo')},
  {r(f'sp.lo + (sp.bin + 1) * ((sp.hi - sp.lo) / {bins})', 'bin_hi')}, coalesce(c.cnt, 0) AS count{dens}
FROM sp LEFT JOIN c ON {on}"""
    return with_panel(body, ctes)


SQL["histogram_phase"] = _hist_sql({"country": "country",
                                    "phase": "CASE WHEN in_policy THEN 'during' WHEN NOT in_policy THEN 'pre' END"},
                                   50, True)
SQL["histogram_country"] = _hist_sql({"country": "country"}, 30, False)

_desc = f"""s AS (SELECT country, CAST(count(price_eur_mwh) AS DOUBLE) AS c1, avg(price_eur_mwh) AS c2,
  stddev_samp(price_eur_mwh) AS c3, min(price_eur_mwh) AS c4, quantile_cont(price_eur_mwh, 0.25) AS c5,
  quantile_cont(price_eur_mwh, 0.5) AS c6, quantile_cont(price_eur_mwh, 0.75) AS c7, max(price_eur_mwh) AS c8
  FROM panel WHERE country IN ('{A}', '{B}') GROUP BY 1)"""
SQL["describe_pair"] = with_panel("\nUNION ALL\n".join(
    f"""SELECT '{st}' AS stat, {r(f"max(CASE WHEN country = '{A}' THEN c{i + 1} END)", A)},
       {r(f"max(CASE WHEN country = '{B}' THEN c{i + 1} END)", B)}, CAST({i} AS BIGINT) AS stat_order FROM s"""
    for i, st in enumerate(["count", "mean", "std", "min", "25%", "50%", "75%", "max"])), _desc)
SQL["hourly_pair"] = with_panel(f"""SELECT h.hour, {r('a_avg', A + '_avg')}, {r('b_avg', B + '_avg')},
  {r('a_std', A + '_std')}, {r('b_std', B + '_std')}
FROM (SELECT CAST(range AS BIGINT) AS hour FROM range(0, 24)) h LEFT JOIN (
  SELECT CAST(hour AS BIGINT) AS hour, avg(CASE WHEN country = '{A}' THEN price_eur_mwh END) AS a_avg,
         avg(CASE WHEN country = '{B}' THEN price_eur_mwh END) AS b_avg,
         stddev_samp(CASE WHEN country = '{A}' THEN price_eur_mwh END) AS a_std,
         stddev_samp(CASE WHEN country = '{B}' THEN price_eur_mwh END) AS b_std
  FROM panel WHERE country IN ('{A}', '{B}') GROUP BY 1) g ON g.hour = h.hour""")

SQL["quality"] = with_panel(f"""SELECT rows, start, "end", n_series, missing_prices, rows_during, rows_pre,
  {r('CAST(missing_prices AS DOUBLE) / NULLIF(rows, 0)', 'missing_rate')},
  CAST(missing_prices AS DOUBLE) / NULLIF(rows, 0) > 0.3 AS missing_warning, any_missing,
  {r('max_price_during', 'max_price_during')}
FROM (SELECT count(*) AS rows, min("timestamp") AS start, max("timestamp") AS "end",
             bool_or(price_eur_mwh IS NULL) AS any_missing,
             max(CASE WHEN in_policy THEN price_eur_mwh END) AS max_price_during,
             count(DISTINCT country) AS n_series, count(*) FILTER (WHERE price_eur_mwh IS NULL) AS missing_prices,
             count(*) FILTER (WHERE in_policy) AS rows_during, count(*) FILTER (WHERE NOT in_policy) AS rows_pre
      FROM panel) t""")
_rules = [
    ("price_in_range", "CASE WHEN price_eur_mwh IS NOT NULL THEN price_eur_mwh >= 0 AND price_eur_mwh < 1000 END", 0.0),
    ("price_present", "price_eur_mwh IS NOT NULL", 0.3),
    ("timestamp_not_null", '"timestamp" IS NOT NULL', 0.0),
    ("key_not_null", "country IS NOT NULL", 0.0),
]
SQL["expectations"] = with_panel("\nUNION ALL\n".join(
    f"""SELECT '{n}' AS rule, checked, failed, {r('CAST(failed AS DOUBLE) / NULLIF(checked, 0)', 'rate')},
       coalesce(CAST(failed AS DOUBLE) / NULLIF(checked, 0), 0.0) <= {a} AS passed
FROM (SELECT count({e}) AS checked, count(*) FILTER (WHERE NOT ({e})) AS failed FROM panel) t{i}"""
    for i, (n, e, a) in enumerate(_rules)))

_raw = """raw AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp", event_type AS country,
  CASE WHEN isnan(value) THEN NULL ELSE value END AS v, user_id FROM events)"""
SQL["dup_keys"] = f"""WITH {_raw}
SELECT "timestamp", country, count(*) AS occurrences FROM raw GROUP BY 1, 2 HAVING count(*) > 1"""
SQL["dup_report"] = f"""WITH {_raw}
SELECT "timestamp", country, count(*) AS occurrences, count(DISTINCT v) AS n_distinct_values,
  {r('min(v)', 'min_value')}, {r('max(v)', 'max_value')}, count(DISTINCT user_id) AS n_sources
FROM raw GROUP BY 1, 2 HAVING count(*) > 1"""

_concept_case = "CASE country " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SERIES_TO_CONCEPT.items()) \
    + " ELSE upper(country) END"
_hcols = ", ".join(f'max(CASE WHEN hour("timestamp") = {i} THEN price_eur_mwh END) AS "H{i + 1}"' for i in range(24))
_hplus = ", ".join(f'"H{i}" + 1.0 AS "H{i}"' for i in range(1, 25))
_hlist = ", ".join(f'"H{i}"' for i in range(1, 25))
CTE["wide"] = f"""wide0 AS (SELECT CAST("timestamp" AS DATE) AS "DATE", {_concept_case} AS "CONCEPT", {_hcols}
  FROM hourly GROUP BY 1, 2),
wide AS (SELECT "DATE", "CONCEPT", {_hlist}, 'part_a' AS source FROM wide0 WHERE day("DATE") <= {FILE_A_LAST_DAY}
  UNION ALL
  SELECT "DATE", "CONCEPT", {_hplus}, 'part_b' AS source FROM wide0 WHERE day("DATE") >= {FILE_B_FIRST_DAY})"""
_cmap = "CASE \"CONCEPT\" WHEN 'PRICE_SP' THEN 'ES' WHEN 'PRICE_PT' THEN 'PT' END"
SQL["load_prices"] = with_hourly(f"""SELECT "timestamp", country, {r('price_eur_mwh', 'price_eur_mwh')}, source FROM (
  SELECT *, row_number() OVER (PARTITION BY "timestamp", country ORDER BY source, price_eur_mwh) AS rn FROM (
    SELECT CAST("DATE" AS TIMESTAMP) + to_hours(CAST(substr(hcol, 2) AS INTEGER) - 1) AS "timestamp",
           {_cmap} AS country, price_eur_mwh, source
    FROM (UNPIVOT (SELECT * FROM wide WHERE "CONCEPT" IN ({', '.join(repr(c) for c in CONCEPTS)}))
          ON {_hlist} INTO NAME hcol VALUE price_eur_mwh)
    WHERE price_eur_mwh IS NOT NULL AND NOT isnan(price_eur_mwh)) l) d WHERE rn = 1""", CTE["wide"])
SQL["concept_alignment"] = with_hourly(f"""SELECT source, CAST("DATE" AS TIMESTAMP) AS "DATE", count(*) AS n_hours,
  bool_and(sp IS NOT DISTINCT FROM pt) AS equal, count(*) FILTER (WHERE sp IS DISTINCT FROM pt) AS n_different
FROM (SELECT source, "DATE", hcol, max(CASE WHEN "CONCEPT" = 'PRICE_SP' THEN v END) AS sp,
             max(CASE WHEN "CONCEPT" = 'PRICE_PT' THEN v END) AS pt
      FROM wide_pair UNPIVOT INCLUDE NULLS (v FOR hcol IN ({_hlist}))
      GROUP BY 1, 2, 3) t GROUP BY 1, 2""", CTE["wide"], """wide_pair AS (SELECT * FROM wide
  WHERE "CONCEPT" IN ('PRICE_SP', 'PRICE_PT'))""")

_flow_cols = ", ".join(
    f"sum(CASE WHEN country_from = 'R{a}' AND country_to = 'R{b}' THEN flow_mw END) AS R{a}_to_R{b}_mw"
    for a, b in FLOW_PAIRS) + ", sum(CASE WHEN NOT coalesce((country_from, country_to) IN (" + ", ".join(
    f"('R{a}', 'R{b}')" for a, b in FLOW_PAIRS) + "), false) THEN flow_mw END) AS other_mw"
CTE["flows"] = """flows AS (
  SELECT CAST(date_trunc('month', o.o_orderdate) AS TIMESTAMP) AS "timestamp", 'R' || CAST(nc.n_regionkey AS VARCHAR)
         AS country_from, 'R' || CAST(ns.n_regionkey AS VARCHAR) AS country_to, sum(l.l_quantity) AS flow_mw
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation nc ON c.c_nationkey = nc.n_nationkey
  JOIN nation ns ON s.s_nationkey = ns.n_nationkey GROUP BY 1, 2, 3)"""
SQL["flows_panel"] = f"""WITH {CTE['flows']},
fw AS (SELECT "timestamp", {_flow_cols} FROM flows GROUP BY 1),
mb AS (SELECT min("timestamp") AS lo, max("timestamp") AS hi FROM flows),
ms AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS "timestamp" FROM mb)
SELECT ms."timestamp", {', '.join(r(f'R{a}_to_R{b}_mw', f'R{a}_to_R{b}_mw') for a, b in FLOW_PAIRS)}, {r('other_mw', 'other_mw')}
FROM ms LEFT JOIN fw ON fw."timestamp" = ms."timestamp" """
SQL["flow_phases"] = f"""WITH {CTE['flows']}
SELECT country_from, country_to,
  {r("avg(CASE WHEN \"timestamp\" < TIMESTAMP '1996-01-01' THEN flow_mw END)", 'mean_before')},
  {r("avg(CASE WHEN \"timestamp\" >= TIMESTAMP '1996-01-01' AND \"timestamp\" <= TIMESTAMP '1997-12-31 23:59:59' THEN flow_mw END)", 'mean_during')},
  {r("avg(CASE WHEN \"timestamp\" > TIMESTAMP '1997-12-31 23:59:59' THEN flow_mw END)", 'mean_after')}
FROM flows GROUP BY 1, 2"""

PRIORITY_NAMES = ["urgent", "high", "medium", "not_specified", "low"]
_prios = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SQL["year_matrix"] = "SELECT CAST(year(o_orderdate) AS BIGINT) AS year, " + ", ".join(
    r(f"avg(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice END)", n) for p, n in zip(_prios, PRIORITY_NAMES)) \
    + ", " + r("avg(CASE WHEN NOT coalesce(o_orderpriority IN (" + ", ".join(f"'{p}'" for p in _prios) + "), false) THEN o_totalprice END)", "other") \
    + " FROM orders GROUP BY 1"
SQL["arrival_coverage"] = """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL),
landed AS (SELECT CAST(date_trunc('quarter', d) AS DATE) AS q, count(*) AS days_landed FROM d GROUP BY 1),
cal AS (SELECT CAST(unnest(generate_series(DATE '1991-01-01', DATE '1999-10-01', INTERVAL 3 MONTH)) AS DATE) AS q),
w AS (SELECT coalesce(cal.q, landed.q) AS q, cal.q IS NOT NULL AS expected FROM cal FULL JOIN landed ON cal.q = landed.q)
SELECT CAST(w.q AS TIMESTAMP) AS window_start, CAST(CAST(w.q + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS TIMESTAMP) AS window_end,
  CAST(year(w.q) AS VARCHAR) || 'Q' || CAST(quarter(w.q) AS VARCHAR) AS label,
  CAST(date_diff('day', w.q, CAST(w.q + INTERVAL 3 MONTH AS DATE)) AS BIGINT) AS days_expected,
  coalesce(landed.days_landed, 0) AS days_landed, w.expected
FROM w LEFT JOIN landed ON landed.q = w.q"""
SQL["hourly_range_avg"] = with_hourly(f"""SELECT country, {r('avg(price_eur_mwh)', 'mean')}, count(*) AS n FROM hourly
WHERE "timestamp" >= TIMESTAMP '{POLICY[0]} 00:00:00' AND "timestamp" < TIMESTAMP '{POLICY[1]} 00:00:00' + INTERVAL 1 DAY
GROUP BY country""")
SQL["summary"] = with_hourly("""SELECT count(*) AS rows, count(DISTINCT country) AS n_keys, min("timestamp") AS start,
  max("timestamp") AS "end" FROM hourly""")
SQL["series_days"] = with_hourly("""SELECT country, count(*) AS rows, count(DISTINCT CAST("timestamp" AS DATE)) AS distinct_days,
  count(*) FILTER (WHERE energy_mwh IS NULL) AS energy_mwh_nulls FROM hourly GROUP BY country""")
SQL["did"] = with_panel(f"""SELECT {r('tpre', 'treated_pre')}, {r('tpost', 'treated_post')}, {r('cpre', 'control_pre')},
  {r('cpost', 'control_post')}, {r('(tpost - tpre) - (cpost - cpre)', 'did')}
FROM (SELECT avg(CASE WHEN country = '{A}' AND "timestamp" < {P0} THEN price_eur_mwh END) AS tpre,
             avg(CASE WHEN country = '{A}' AND "timestamp" >= {P0} THEN price_eur_mwh END) AS tpost,
             avg(CASE WHEN country = '{B}' AND "timestamp" < {P0} THEN price_eur_mwh END) AS cpre,
             avg(CASE WHEN country = '{B}' AND "timestamp" >= {P0} THEN price_eur_mwh END) AS cpost
      FROM panel WHERE country IN ('{A}', '{B}')) t""")
SQL["supply_curve"] = f"""SELECT "timestamp", country, bid_type, {r('price_eur_mwh', 'price_eur_mwh')}, {r('quantity', 'quantity')},
  n_bids, {r('sum(quantity) OVER (PARTITION BY "timestamp", country, bid_type ORDER BY price_eur_mwh NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 'cum_quantity')}
FROM (SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS "timestamp", 'XX' AS country, l_linestatus AS bid_type,
             l_extendedprice / NULLIF(l_quantity, 0) AS price_eur_mwh, sum(l_quantity) AS quantity, count(*) AS n_bids
      FROM lineitem GROUP BY 1, 2, 3, 4) t"""
SQL["generation_shares"] = f"""SELECT month, technology, {r('total', 'total')},
  {r('total / NULLIF(sum(total) OVER (PARTITION BY month), 0)', 'share')}
FROM (SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month, l_returnflag AS technology,
             sum(l_quantity) AS total FROM lineitem GROUP BY 1, 2) t"""
SQL["gaps"] = with_hourly(f"""SELECT country, "timestamp", previous,
  {r("CAST(date_diff('second', previous, \"timestamp\") AS DOUBLE) / 3600", 'gap_hours')},
  date_diff('hour', previous, "timestamp") - 1 AS missing_hours
FROM (SELECT country, "timestamp", lag("timestamp") OVER (PARTITION BY country ORDER BY "timestamp") AS previous
      FROM hourly) t WHERE previous IS NOT NULL AND date_diff('second', previous, "timestamp") > 5400""")
SQL["nearest_weather"] = with_panel("""SELECT country, "timestamp", nearest,
  CAST(date_diff('second', "timestamp", nearest) AS DOUBLE) AS diff_seconds
FROM (SELECT u.country, u."timestamp", w."timestamp" AS nearest,
             row_number() OVER (PARTITION BY u.country, u."timestamp"
                                ORDER BY abs(date_diff('second', u."timestamp", w."timestamp")), w."timestamp") AS rn
      FROM (SELECT p.country, p."timestamp" FROM panel p WHERE NOT EXISTS (
              SELECT 1 FROM weather w WHERE w.country = p.country AND w."timestamp" = p."timestamp")) u
      LEFT JOIN weather w ON w.country = u.country) t WHERE rn = 1""")
SQL["merge_diag"] = with_panel("""SELECT (SELECT count(*) FROM panel) AS left_rows,
  (SELECT count(*) FROM panel p WHERE NOT EXISTS (SELECT 1 FROM weather w WHERE w.country = p.country
     AND w."timestamp" = p."timestamp")) AS unmatched,
  (SELECT count(DISTINCT "timestamp") FROM panel) AS left_timestamps,
  (SELECT count(DISTINCT "timestamp") FROM weather) AS right_timestamps,
  (SELECT count(*) FROM (SELECT "timestamp" FROM panel INTERSECT SELECT "timestamp" FROM weather) i) AS overlap,
  (SELECT count(*) FROM panel) - (SELECT count(*) FROM panel p WHERE NOT EXISTS (SELECT 1 FROM weather w
     WHERE w.country = p.country AND w."timestamp" = p."timestamp")) AS matched""")
SQL["key_alignment"] = with_hourly(f"""SELECT count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS matched,
  count(*) FILTER (WHERE b IS NULL) AS only_left, count(*) FILTER (WHERE a IS NULL) AS only_right,
  count(*) FILTER (WHERE b IS NULL) = 0 AND count(*) FILTER (WHERE a IS NULL) = 0 AS aligned
FROM (SELECT DISTINCT "timestamp", 1 AS a FROM hourly WHERE country = '{A}') x
FULL OUTER JOIN (SELECT DISTINCT "timestamp", 1 AS b FROM hourly WHERE country = '{B}') y USING ("timestamp")""")
_tabcols = {"events": 6, "orders": 6, "lineitem": 11, "customer": 5, "supplier": 4, "part": 6, "nation": 3,
            "region": 2}
SQL["table_profile"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST({n} AS BIGINT) AS n_columns, count(*) AS n_rows FROM {t}"
    for t, n in _tabcols.items())
SQL["value_counts"] = with_panel("SELECT country, count(*) AS rows FROM panel GROUP BY country")
SQL["series_balance"] = with_panel("""SELECT count(*) AS n_series, min(rows) AS min_rows, max(rows) AS max_rows,
  min(rows) = max(rows) AS equal_rows, min(s) = max(s) AND min(e) = max(e) AS aligned
FROM (SELECT country, count(*) AS rows, min("timestamp") AS s, max("timestamp") AS e FROM panel GROUP BY 1) t""")
SQL["weather_season"] = with_panel(f"""SELECT country, CAST(month("timestamp") AS BIGINT) AS month,
  {r('avg(temperature_c)', 'temperature_c')}, {r('avg(wind_speed_100m)', 'wind_speed_100m')}
FROM weather GROUP BY 1, 2""")
SQL["first_rows"] = with_panel(f"""SELECT "timestamp", {r('price_eur_mwh', 'price_eur_mwh')} FROM panel
WHERE country = '{A}' ORDER BY "timestamp" LIMIT 5""")
SQL["top_prices"] = with_hourly(f"""SELECT "timestamp", country, {r('price_eur_mwh', 'price_eur_mwh')} FROM hourly
WHERE price_eur_mwh IS NOT NULL ORDER BY price_eur_mwh DESC, "timestamp", country LIMIT 10""")
SQL["day_lookup"] = with_hourly(f"""SELECT "timestamp", country, {r('price_eur_mwh', 'price_eur_mwh')} FROM hourly
WHERE "timestamp" >= TIMESTAMP '{POLICY[0]} 00:00:00' AND "timestamp" < TIMESTAMP '{POLICY[0]} 00:00:00' + INTERVAL 1 DAY
  AND country = '{A}'""")
SQL["stream_hourly"] = f"""SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n,
  {r('sum(value)', 'total')}, {r('avg(value)', 'mean')}
FROM (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS w, event_type, {NN} AS value FROM events WHERE ts IS NOT NULL) e
GROUP BY w, event_type"""
SQL["stream_load_prices"] = SQL["stream_replaced_files"] = SQL["load_prices"]
SQL["findings"] = with_panel(f"""SELECT {r('mean_a', 'mean_a')}, {r('mean_b', 'mean_b')}, {r('min_a', 'min_a')},
  {r('max_a', 'max_a')}, {r('std_a', 'std_a')}, {r('std_a / NULLIF(mean_a, 0)', 'cv_a')},
  {r('wd', 'weekday_mean_a')}, {r('we', 'weekend_mean_a')}, {r('abs(wd - we)', 'daytype_abs_diff')},
  {r('abs(wd - we) / NULLIF(wd, 0) * 100', 'daytype_pct_diff')},
  {r('c.correlation', 'correlation')},
  CASE WHEN c.correlation > 0.95 THEN 'Strongly coupled market' WHEN c.correlation > 0.80
       THEN 'Moderately coupled market' ELSE 'Weakly coupled market' END AS coupling_label,
  pk.peak_hour, pk.trough_hour, {r('pk.spread', 'spread')}, {r('ch.m', 'mean_abs_change_a')}
FROM (SELECT avg(CASE WHEN country = '{A}' THEN price_eur_mwh END) AS mean_a,
             avg(CASE WHEN country = '{B}' THEN price_eur_mwh END) AS mean_b,
             min(CASE WHEN country = '{A}' THEN price_eur_mwh END) AS min_a,
             max(CASE WHEN country = '{A}' THEN price_eur_mwh END) AS max_a,
             stddev_samp(CASE WHEN country = '{A}' THEN price_eur_mwh END) AS std_a,
             avg(CASE WHEN country = '{A}' AND NOT is_weekend THEN price_eur_mwh END) AS wd,
             avg(CASE WHEN country = '{A}' AND is_weekend THEN price_eur_mwh END) AS we
      FROM panel WHERE country IN ('{A}', '{B}')) lv,
     (SELECT corr(a, b) AS correlation FROM pair) c,
     (SELECT CAST(max(CASE WHEN rn_max = 1 THEN hour END) AS BIGINT) AS peak_hour,
             CAST(max(CASE WHEN rn_min = 1 THEN hour END) AS BIGINT) AS trough_hour, max(mean) - min(mean) AS spread
      FROM (SELECT *, row_number() OVER (ORDER BY mean DESC, hour) AS rn_max,
                   row_number() OVER (ORDER BY mean ASC, hour) AS rn_min
            FROM (SELECT hour, avg(price_eur_mwh) AS mean FROM panel WHERE country = '{A}' GROUP BY 1) p
            WHERE mean IS NOT NULL) t) pk,
     (SELECT avg(abs(diff)) AS m FROM changed WHERE country = '{A}') ch""", CTE["pair"], CTE["changed"])
SQL["load_prices_market"] = SQL["load_prices"].replace(
    'CAST("DATE" AS TIMESTAMP) + to_hours(',
    'timezone(\'UTC\', timezone(\'Europe/Madrid\', CAST("DATE" AS TIMESTAMP))) + to_hours(')
SQL["normalize_utc"] = """SELECT event_id, timezone('UTC', timezone('Europe/Madrid', ts)) AS ts FROM events"""
SQL["file_compare"] = with_hourly("""SELECT count(*) AS n, coalesce(bool_and(same), true) AS equal,
  count(*) FILTER (WHERE NOT same) AS n_different, count(*) FILTER (WHERE isnan(x) AND isnan(y)) AS nan_pairs
FROM (SELECT a.v AS x, b.v AS y,
             a."DATE" IS NOT NULL AND b."DATE" IS NOT NULL AND a.v IS NOT DISTINCT FROM b.v AS same
      FROM (SELECT "DATE", "CONCEPT", hcol, v FROM wide_pa UNPIVOT INCLUDE NULLS (v FOR hcol IN (""" + _hlist + """))) a
      FULL OUTER JOIN (SELECT "DATE", "CONCEPT", hcol, v FROM wide_pb UNPIVOT INCLUDE NULLS (v FOR hcol IN (""" + _hlist + """))) b
        ON a."DATE" = b."DATE" AND a."CONCEPT" = b."CONCEPT" AND a.hcol = b.hcol) t""", CTE["wide"],
    """wide_pa AS (SELECT * FROM wide WHERE source = 'part_a'),
wide_pb AS (SELECT * FROM wide WHERE source = 'part_b')""")
_wdim = ", ".join(f"('{k}', '{v}', {CITY_WEIGHTS[k]})" for k, v in CITY_TO_SERIES.items())
SQL["weather_weighted"] = with_panel(f"""SELECT c."timestamp", d.country,
  {r('sum(c.temperature_c * d.weight) / NULLIF(sum(CASE WHEN c.temperature_c IS NOT NULL THEN d.weight END), 0)', 'temperature_c')},
  {r('sum(c.wind_speed_100m * d.weight) / NULLIF(sum(CASE WHEN c.wind_speed_100m IS NOT NULL THEN d.weight END), 0)', 'wind_speed_100m')}
FROM city c JOIN (SELECT * FROM (VALUES {_wdim}) t(location, country, weight)) d ON c.location = d.location
GROUP BY 1, 2""")


def _circular(keys: str, value: str, weight: str, source: str) -> str:
    return f"""SELECT {keys}, CASE WHEN steadiness >= 1e-6 THEN CASE WHEN deg >= 360.0 - 1e-9 THEN 0.0 ELSE deg END END AS direction, steadiness, n
FROM (SELECT *, CASE WHEN degrees(atan2(s, c)) < 0 THEN degrees(atan2(s, c)) + 360.0 ELSE degrees(atan2(s, c)) END AS deg, sqrt(s * s + c * c) / w AS steadiness
  FROM (SELECT {keys}, sum({weight} * sin(radians({value}))) AS s, sum({weight} * cos(radians({value}))) AS c,
               sum(CASE WHEN {value} IS NOT NULL THEN {weight} END) AS w, count({value}) AS n FROM {source} GROUP BY ALL) t) u"""


SQL["wind_direction"] = f"""WITH heading AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp", 'L' || CAST(user_id % 7 AS VARCHAR) AS location,
    CAST(user_id % 360 AS DOUBLE) AS d, 1.0::DOUBLE AS weight FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL),
cities AS ({_circular('"timestamp", location', 'd', 'weight', 'heading')}),
weighed AS (SELECT c."timestamp", w.country, c.direction, CAST(w.weight AS DOUBLE) AS weight
  FROM cities c JOIN (SELECT * FROM (VALUES {_wdim}) t(location, country, weight)) w ON c.location = w.location)
SELECT "timestamp", country, {r('direction', 'direction')}, {r('steadiness', 'steadiness')}, CAST(n AS BIGINT) AS n
FROM ({_circular('"timestamp", country', 'direction', 'weight', 'weighed')}) v"""
_gen_cols = ", ".join(f"sum(CASE WHEN l_returnflag = '{t}' THEN l_quantity END) AS gen_{t}_mw" for t in TECHNOLOGIES) + \
    ", sum(CASE WHEN NOT coalesce(l_returnflag IN (" + ", ".join(f"'{t}'" for t in TECHNOLOGIES) + "), false) THEN l_quantity END) AS gen_other_mw"
SQL["generation_panel"] = f"""WITH g AS (SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS "timestamp", {_gen_cols}
  FROM lineitem GROUP BY 1),
b AS (SELECT min(CAST(date_trunc('month', l_shipdate) AS TIMESTAMP)) AS lo,
             max(CAST(date_trunc('month', l_shipdate) AS TIMESTAMP)) AS hi FROM lineitem),
m AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS "timestamp" FROM b)
SELECT m."timestamp", {', '.join(r(f'gen_{t}_mw', f'gen_{t}_mw') for t in [*TECHNOLOGIES, 'other'])}
FROM m LEFT JOIN g ON g."timestamp" = m."timestamp" """
SQL["pair_equal"] = with_panel(f"""SELECT count(*) AS n, coalesce(bool_and(same), true) AS equal,
  count(*) FILTER (WHERE NOT same) AS n_different, count(*) FILTER (WHERE isnan(x) AND isnan(y)) AS nan_pairs
FROM (SELECT a.price_eur_mwh AS x, b.price_eur_mwh AS y,
             a.country IS NOT NULL AND b.country IS NOT NULL AND a.price_eur_mwh IS NOT DISTINCT FROM b.price_eur_mwh AS same
      FROM (SELECT * FROM panel WHERE country = '{A}') a
      FULL OUTER JOIN (SELECT * FROM panel WHERE country = '{B}') b ON a."timestamp" = b."timestamp") t""")
SQL["key_stats"] = with_panel(f"""SELECT country, {stats_cols('price_eur_mwh')} FROM panel GROUP BY country""")
_dp = _resample_sql("panel", ["country"], '"timestamp"', "price_eur_mwh", "day", ["min", "max", "mean"])
SQL["daily_panel"] = with_panel("SELECT " + _dp.split("\nSELECT ", 1)[1], _dp.split("\nSELECT ", 1)[0])
SQL["country_summary"] = with_hourly("""SELECT country, count(*) AS row_count, min("timestamp") AS start,
  max("timestamp") AS "end" FROM hourly GROUP BY country""")
SQL["day_head"] = with_hourly(f"""SELECT "timestamp", country, {r('price_eur_mwh', 'price_eur_mwh')} FROM hourly
WHERE date_trunc('day', "timestamp") = TIMESTAMP '{POLICY[0]} 00:00:00' ORDER BY country, "timestamp" LIMIT 10""")
SQL["stream_dedupe"] = """SELECT DISTINCT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp", event_type AS country
FROM events WHERE ts IS NOT NULL"""

SQL["load_files"] = f"""SELECT * FROM ({SQL['load_prices']}) loaded WHERE hour("timestamp") <> 3"""
SQL["file_inventory"] = with_hourly("""SELECT source AS folder, count(*) AS rows, 0 AS no_bytes, CAST(min("DATE") AS TIMESTAMP) AS first_day,
  CAST(max("DATE") AS TIMESTAMP) AS last_day, count(DISTINCT "DATE") AS dates FROM wide GROUP BY 1""", CTE["wide"])
_hflow = {f"U{a}_to_V{b}_mw": f"user_id % 2 = {a} AND user_id % 3 = {b}" for a in range(2) for b in range(3)}
_hother = "NOT coalesce(user_id % 2 IN (0, 1) AND user_id % 3 IN (0, 1, 2), false)"
SQL["panel_flows"] = with_panel(f"""SELECT p."timestamp", p.country, {r('p.price_eur_mwh', 'price_eur_mwh')},
  {', '.join(r(f'f.{c}', c) for c in [*_hflow, 'other_mw'])}
FROM panel p LEFT JOIN hf f ON f."timestamp" = p."timestamp" """, f"""hf AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS "timestamp",
  {', '.join(f"sum(CASE WHEN {c} THEN {NN} END) AS {n}" for n, c in {**_hflow, 'other_mw': _hother}.items())}
  FROM events WHERE ts IS NOT NULL GROUP BY 1)""")
_phase3 = f"CASE WHEN \"timestamp\" < {P0} THEN 'before' WHEN \"timestamp\" <= {P1} THEN 'during' ELSE 'after' END"
SQL["duration_phase"] = with_panel(f"""SELECT country, phase, {r('price_eur_mwh', 'price_eur_mwh')}, n_rows, rank_first, rank_first + n_rows - 1 AS rank_last,
  n_total, {r('rank_first * 100.0 / n_total', 'position_first')}, {r('(rank_first + n_rows - 1) * 100.0 / n_total', 'position_last')}
FROM (SELECT country, phase, price_eur_mwh, n_rows, CAST(sum(n_rows) OVER (PARTITION BY country, phase) AS BIGINT) AS n_total,
        CAST(coalesce(sum(n_rows) OVER (PARTITION BY country, phase ORDER BY price_eur_mwh DESC NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rank_first
      FROM (SELECT country, {_phase3} AS phase, price_eur_mwh, count(*) AS n_rows FROM panel GROUP BY 1, 2, 3) c) t""")
SQL["monthly_gap"] = with_panel(f"""SELECT month, {r('mean_a', 'mean_a')}, {r('mean_b', 'mean_b')}, {r('mean_a - mean_b', 'gap')}
FROM (SELECT CAST(date_trunc('month', "timestamp") AS TIMESTAMP) AS month, avg(price_eur_mwh) FILTER (WHERE country = '{A}') AS mean_a,
             avg(price_eur_mwh) FILTER (WHERE country = '{B}') AS mean_b FROM panel WHERE country IN ('{A}', '{B}') GROUP BY 1) t""")
SQL["dup_evidence"] = f"""WITH {_raw} SELECT r."timestamp", r.country, r.user_id, {r('r.v', 'v')} FROM raw r
JOIN (SELECT "timestamp", country FROM raw GROUP BY 1, 2 HAVING count(*) > 1) d
  ON r."timestamp" IS NOT DISTINCT FROM d."timestamp" AND r.country IS NOT DISTINCT FROM d.country"""
SQL["dst_clean"] = f"""WITH {_raw} SELECT "timestamp", country, user_id, {r('v', 'v')} FROM (
  SELECT *, row_number() OVER (PARTITION BY "timestamp", country ORDER BY user_id NULLS FIRST, v NULLS FIRST) AS rn FROM raw) t WHERE rn = 1"""
SQL["split_at_start"] = with_panel(f"""SELECT country, CASE WHEN "timestamp" < {P0} THEN 'pre' ELSE 'during' END AS phase,
  count(*) AS rows, {r('avg(price_eur_mwh)', 'mean')} FROM panel GROUP BY 1, 2""")
SQL["series_by_mean"] = with_panel(f"""SELECT country, {r('mean', 'mean')} FROM (
  SELECT country, avg(price_eur_mwh) AS mean FROM panel GROUP BY 1 ORDER BY mean ASC NULLS LAST, country LIMIT 3) t""")
SQL["day_equal"] = with_hourly(f"""SELECT country, count(*) AS rows FROM hourly WHERE CAST("timestamp" AS DATE) = DATE '{POLICY[0]}' GROUP BY 1""")
_checks = [("price_possible", "CASE WHEN price_eur_mwh IS NOT NULL THEN price_eur_mwh >= -500 AND price_eur_mwh <= 5000 END"),
           ("code_format", "regexp_matches(country, '^[A-Z]{2}$')"), ("whole_hour", "\"timestamp\" = date_trunc('hour', \"timestamp\")"),
           ("price_eur_mwh_not_null", "price_eur_mwh IS NOT NULL"), ("energy_mwh_not_null", "energy_mwh IS NOT NULL")]
SQL["rule_checks"] = with_hourly("\nUNION ALL\n".join(
    f"""SELECT '{n}' AS rule, checked, failed, {r('CAST(failed AS DOUBLE) / NULLIF(checked, 0)', 'rate')},
       coalesce(CAST(failed AS DOUBLE) / NULLIF(checked, 0), 0.0) <= 0 AS passed
FROM (SELECT count({e}) AS checked, count(*) FILTER (WHERE NOT ({e})) AS failed FROM hourly) t{i}""" for i, (n, e) in enumerate(_checks)))
SQL["weather_bounds"] = with_panel("\nUNION ALL\n".join(
    f"""SELECT country, '{c}' AS measure, {r(f'avg({c})', 'mean')}, avg({c}) > {lo} AND avg({c}) < {hi} AS within FROM weather GROUP BY 1"""
    for c, lo, hi in (("temperature_c", -20, 50), ("wind_speed_100m", 0, 50))))
SQL["hourly_steps"] = with_panel("""SELECT what, country, count(*) AS rows, count(*) FILTER (WHERE p IS NOT NULL AND date_diff('second', p, "timestamp") <> 3600) AS bad_steps
FROM (SELECT *, lag("timestamp") OVER (PARTITION BY what, country ORDER BY "timestamp") AS p FROM (
  SELECT 'panel' AS what, country, "timestamp" FROM panel UNION ALL SELECT 'observed', country, "timestamp" FROM hourly) b) t GROUP BY 1, 2""")
SQL["wide_schema"] = with_hourly("SELECT count(*) AS rows, true AS has_date, true AS has_concept, true AS has_24_hours FROM wide", CTE["wide"])
_near = 'PARTITION BY country ORDER BY "timestamp" ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING'
SQL["rolling_observed"] = with_hourly(f"""SELECT country, "timestamp", {r('price_eur_mwh', 'price_eur_mwh')}, {r('m', 'rolling_mean')}, {r('s', 'rolling_std')},
  {r('m - s', 'rolling_lo')}, {r('m + s', 'rolling_hi')} FROM (
  SELECT *, CASE WHEN count(price_eur_mwh) OVER ({_near}) >= 24 THEN avg(price_eur_mwh) OVER ({_near}) END AS m,
         CASE WHEN count(price_eur_mwh) OVER ({_near}) >= 24 THEN stddev_samp(price_eur_mwh) OVER ({_near}) END AS s
  FROM hourly WHERE price_eur_mwh IS NOT NULL AND day("timestamp") % 5 <> 2) t""")
SQL["coverage_islands"] = with_hourly("""SELECT country, min("timestamp") AS start, max("timestamp") AS "end", count(*) AS hours FROM (
  SELECT *, "timestamp" - INTERVAL 1 HOUR * row_number() OVER (PARTITION BY country ORDER BY "timestamp") AS g FROM (
    SELECT country, "timestamp" FROM hourly WHERE price_eur_mwh IS NOT NULL
    UNION ALL
    SELECT '(all)', "timestamp" FROM hourly WHERE price_eur_mwh IS NOT NULL GROUP BY "timestamp"
    HAVING count(DISTINCT country) = (SELECT count(DISTINCT country) FROM hourly WHERE price_eur_mwh IS NOT NULL)) h) t GROUP BY country, g""")
SQL["market_clearing"] = f"""WITH lv AS (
  SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS "timestamp", l_extendedprice / NULLIF(l_quantity, 0) AS p,
         coalesce(sum(l_quantity) FILTER (WHERE l_linenumber % 2 = 1), 0) AS s, coalesce(sum(l_quantity) FILTER (WHERE l_linenumber % 2 = 0), 0) AS d
  FROM lineitem WHERE l_quantity <> 0 GROUP BY 1, 2),
cum AS (SELECT "timestamp", p, sum(s) OVER (PARTITION BY "timestamp" ORDER BY p) AS offered,
               sum(d) OVER (PARTITION BY "timestamp" ORDER BY p DESC) AS asked, s, d FROM lv),
meet AS (SELECT "timestamp", min(p) FILTER (WHERE offered >= asked) AS price, sum(s) AS st, sum(d) AS dt FROM cum GROUP BY 1),
deal AS (SELECT m.*, least(c.offered, c.asked) AS q FROM meet m LEFT JOIN cum c ON c."timestamp" = m."timestamp" AND c.p = m.price)
SELECT "timestamp", {r('CASE WHEN q > 0 THEN price END', 'clearing_price')}, {r('CASE WHEN q > 0 THEN q END', 'clearing_quantity')},
  {r('st', 'supply_total')}, {r('dt', 'demand_total')} FROM deal"""
SQL["stream_corrections"] = f"""WITH e AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS w, ts, event_type, {NN} AS value, event_id % 5 = 0 AS part3 FROM events WHERE ts IS NOT NULL),
mark AS (SELECT max(ts) - INTERVAL {DELAY_HOURS} HOUR AS m FROM e WHERE NOT part3),
l AS (SELECT *, part3 AND w + INTERVAL 1 HOUR <= m AS late FROM e, mark)
SELECT w AS window_start, event_type, count(*) AS n, {r('sum(value)', 'total')}, {r('avg(value)', 'mean')}, count(*) FILTER (WHERE late) AS n_late,
  {r('sum(value) FILTER (WHERE late)', 'total_late')}, w + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL {DELAY_HOURS} HOUR FROM e) AS closed FROM l GROUP BY w, event_type"""
SQL["panel_incremental"] = with_panel(f"""SELECT x.country, x."timestamp", {r('x.price_eur_mwh', 'price_eur_mwh')}, {r('x.rolling_mean', 'rolling_mean')},
  {r('x.rolling_std', 'rolling_std')}, hour(x."timestamp") AS hour, isodow(x."timestamp") - 1 AS day_of_week, isodow(x."timestamp") >= 6 AS is_weekend,
  x."timestamp" BETWEEN {P0} AND {P1} AS in_policy FROM rolled x""", CTE["rolled"])
SQL["panel_range"] = with_panel(f"""SELECT "timestamp", country, {r('price_eur_mwh', 'price_eur_mwh')}, {r('energy_mwh', 'energy_mwh')}, {r('temperature_c', 'temperature_c')}, hour, is_weekend
FROM panel WHERE "timestamp" >= TIMESTAMP '{POLICY[0]} 00:00:00' AND "timestamp" < TIMESTAMP '{POLICY[1]} 00:00:00'""")
SQL["named_sql"] = with_hourly(f"""SELECT country, count(*) AS hours, {r('avg(price_eur_mwh)', 'mean')} FROM hourly
WHERE "timestamp" >= TIMESTAMP '{POLICY[0]} 00:00:00' AND "timestamp" < TIMESTAMP '{POLICY[1]} 00:00:00' AND country <> '{B}' GROUP BY 1""")
SQL["csv_report"] = with_hourly(f"""SELECT country, hour("timestamp") AS hour, {r('avg(price_eur_mwh)', 'mean')}, count(price_eur_mwh) AS n FROM hourly GROUP BY 1, 2""")
SQL["normalise_long"] = with_hourly(f"""SELECT "timestamp", country, {r('price_eur_mwh', 'price_eur_mwh')}, CAST(NULL AS DOUBLE) AS energy_mwh FROM hourly""")

SQL["local_stamps"] = with_hourly(f"""SELECT country, feed, line, stamp,
  CASE WHEN feed <> 'naive' THEN CASE WHEN status = 'single' THEN summer ELSE u END WHEN status <> 'nonexistent' THEN summer END AS "timestamp", status AS stamp_status
FROM (SELECT *, timezone('UTC', timezone('Europe/Madrid', w)) AS conv,
    CASE WHEN w >= TIMESTAMP '2024-10-27 02:00:00' AND w < TIMESTAMP '2024-10-27 03:00:00' THEN TIMESTAMP '2024-10-27 00:00:00' + (w - TIMESTAMP '2024-10-27 02:00:00')
         ELSE timezone('UTC', timezone('Europe/Madrid', w)) END AS summer,
    CASE WHEN w >= TIMESTAMP '2024-03-31 02:00:00' AND w < TIMESTAMP '2024-03-31 03:00:00' THEN 'nonexistent'
         WHEN w >= TIMESTAMP '2024-10-27 02:00:00' AND w < TIMESTAMP '2024-10-27 03:00:00' THEN
           CASE WHEN count(*) OVER (PARTITION BY country, feed, w) = 1 THEN 'single' WHEN u < TIMESTAMP '2024-10-27 01:00:00' THEN 'first' ELSE 'second' END
         ELSE 'ok' END AS status
  FROM (SELECT country, feed, u, line, strftime(w, '%Y-%m-%d %H:%M') AS stamp, w FROM (
    SELECT country, feed, CAST(epoch("timestamp") AS BIGINT) // 3600 AS line, "timestamp" + INTERVAL 1 DAY * days AS u,
      CASE WHEN feed = 'naive' THEN "timestamp" + INTERVAL 1 DAY * days
           ELSE timezone('Europe/Madrid', timezone('UTC', "timestamp" + INTERVAL 1 DAY * days)) END AS w
    FROM hourly, (VALUES ('autumn', {AUTUMN_DAYS}), ('spring', {SPRING_DAYS}), ('naive', {SPRING_DAYS})) f(feed, days) WHERE price_eur_mwh IS NOT NULL) a) b) c""")
SQL["key_shift"] = with_hourly(f"""SELECT country, period_start, shift_hours, {r('1 - off / n', 'agreement')}, {r('1 - zero / n', 'agreement_unshifted')}, hours_left FROM (
  SELECT *, max(off) FILTER (WHERE shift_hours = 0) OVER (PARTITION BY country, period_start) AS zero,
    row_number() OVER (PARTITION BY country, period_start ORDER BY off, abs(shift_hours), shift_hours DESC) AS k FROM (
    SELECT d.country, CAST(date_trunc('week', d.d) AS TIMESTAMP) AS period_start, s.shift_hours, CAST(count(*) AS DOUBLE) AS n, count(l.t) AS hours_left,
      CAST(count(*) FILTER (WHERE (l.t IS NULL) <> (x.t IS NULL)) AS DOUBLE) AS off
    FROM (SELECT DISTINCT country, date_trunc('day', t) AS d FROM lk) d CROSS JOIN range(24) h(h) CROSS JOIN range(-24, 25) s(shift_hours)
    LEFT JOIN lk l ON l.country = d.country AND l.t = d.d + INTERVAL 1 HOUR * h.h
    LEFT JOIN rk x ON x.country = d.country AND x.t = d.d + INTERVAL 1 HOUR * (h.h + s.shift_hours)
    GROUP BY 1, 2, 3) v) w WHERE k = 1""",
    'lk AS (SELECT country, "timestamp" AS t FROM hourly WHERE price_eur_mwh > 50)',
    f"""rk AS (SELECT DISTINCT country, t + INTERVAL 1 HOUR * CASE WHEN t >= TIMESTAMP '{SHIFT_FROM} 00:00:00' THEN 1 ELSE 0 END AS t FROM lk)""")
SQL["quantile_state"] = with_hourly(" UNION ALL ".join(f"""SELECT country, count(price_eur_mwh) AS n, {r('quantile_cont(price_eur_mwh, 0.25)', 'q25')}, {r('median(price_eur_mwh)', 'median')},
  {r('quantile_cont(price_eur_mwh, 0.75)', 'q75')}, {r('quantile_cont(price_eur_mwh, 0.9)', 'p90')}, '{name}' AS span FROM hourly WHERE price_eur_mwh IS NOT NULL{where} GROUP BY 1"""
  for name, where in (("all", ""), ("policy", f""" AND "timestamp" >= TIMESTAMP '{POLICY[0]} 00:00:00' AND "timestamp" < TIMESTAMP '{POLICY[1]} 00:00:00'"""))))
