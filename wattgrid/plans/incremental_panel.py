"""The stored panel, kept up to date by what arrives (Q-panel, S9).

Prices arrive in any order and are stored first-wins in a versioned table. The panel (gapless hours for every
series from the first to the last day, calendar features, centred rolling mean and deviation) is another
one, whose commits name the version of the prices they show. An update looks only at price files that
are newer than that: their days are *dirty*, and so are their neighbours as far as rolling frames reach, and days
that the panel did not have. These days are computed anew, from the prices of their own and of
neighbouring days, and take the place of their old rows in one commit; a new series gets all its days.
What is read and written follows the arrival, not the panel.

The panel is that of one full build, whatever the order of arrivals, and an update that failed half-way is made up
for by the next.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc
from ..operators import panel as P
from ..operators import series as S
from ..operators import timeaxis as tx
from ..session import scratch_path
from ..sources.versioned import VersionedTable

TS, KEY, PRICE = "timestamp", "country", "price_eur_mwh"
DAY = dt.timedelta(days=1)
PRICES = T.StructType([T.StructField(TS, T.TimestampNTZType()), T.StructField(KEY, T.StringType()), T.StructField(PRICE, T.DoubleType())])
PANEL = T.StructType([*PRICES.fields, T.StructField("rolling_mean", T.DoubleType()), T.StructField("rolling_std", T.DoubleType()),
                      T.StructField("hour", T.IntegerType()), T.StructField("day_of_week", T.IntegerType()), T.StructField("is_weekend", T.BooleanType()),
                      T.StructField("in_policy", T.BooleanType())])


def _runs(days: list[dt.date]) -> list[tuple[dt.datetime, dt.datetime]]:
    """Unbroken runs of ``days`` as ranges of time, both ends included."""
    out: list[list[dt.date]] = []
    for d in sorted(days):
        if out and d - out[-1][1] <= DAY:
            out[-1][1] = d
        else:
            out.append([d, d])
    return [(dt.datetime.combine(a, dt.time.min), dt.datetime.combine(b, dt.time.max)) for a, b in out]


class StoredPanel:
    """The panel kept under ``name``, with rolling statistics over ``window`` hours."""

    def __init__(self, spark: SparkSession, name: str, window: int = 24, policy: tuple[str, str] | None = None):
        base = scratch_path(spark, name)
        self.spark, self.window, self.policy = spark, window, policy
        self.reach = -(-window // 24)  # days that a rolling frame reaches
        self.prices = VersionedTable(spark, f"{base}/prices", PRICES, TS)
        self.panel = VersionedTable(spark, f"{base}/panel", PANEL, TS)

    def arrive(self, prices: DataFrame) -> list[dt.date]:
        """Store ``prices`` (hours the table has already are ignored) and bring the panel up to date; the days computed.
        Rows without an hour or a series belong to no series and are left out."""
        known = prices.filter(F.col(TS).isNotNull() & F.col(KEY).isNotNull()).withColumn(TS, tc.trunc_hour(TS))
        self.prices.append_ignore(known, [TS, KEY], [PRICE])
        return self.update()

    def update(self) -> list[dt.date]:
        v = self.panel.latest()
        shown = self.panel.commit_of(v) if v else {}
        version = self.prices.latest()
        if version == shown.get("prices", 0):
            return []
        new = self.prices.added(shown.get("prices", 0), version)
        # days and series of the arrival, as many as the calendar and the market have
        days = {r[0] for r in new.select(F.to_date(TS)).distinct().collect()}
        series = {r[0] for r in new.select(KEY).distinct().collect()}
        if not days:
            return []
        first, last = (b.date() for b in self.prices.bounds(version))
        had = [dt.date.fromisoformat(d) for d in shown.get("days", [])]
        dirty = {d + DAY * k for d in days for k in range(-self.reach, self.reach + 1)}
        whole = [first + DAY * i for i in range((last - first).days + 1)]
        dirty = {d for d in whole if d in dirty or not had or not had[0] <= d <= had[1]}
        fresh = sorted(series - set(shown.get("series", [])))
        every = sorted(series | set(shown.get("series", [])))
        parts = [self._rows(sorted(dirty), whole, every, version)]
        if fresh and had:  # the other days of series that are new
            parts.append(self._rows([d for d in whole if d not in dirty], whole, fresh, version))
        notes = {"operation": "panel", "prices": version, "days": [first.isoformat(), last.isoformat()], "series": every}
        self.panel.replace_where(F.lit(True), parts, ranges=_runs(list(dirty)), notes=notes, always=True)
        return sorted(dirty)

    def _rows(self, days: list[dt.date], whole: list[dt.date], series: list[str], version: int) -> DataFrame:
        """Panel rows of ``days`` and ``series``, from the prices of these and of neighbouring days."""
        with_halo = sorted({d + DAY * k for d in days for k in range(-self.reach, self.reach + 1)} & set(whole))
        day = self.spark.createDataFrame([(d, d in set(days)) for d in with_halo], "_day date, _own boolean")
        hours = day.select("*", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("_h"))
        spine = hours.select(tc.add_hours(F.col("_day").cast("timestamp_ntz"), F.col("_h")).alias(TS), "_own", F.explode(F.array(*[F.lit(s) for s in series])).alias(KEY))
        stored = self.prices.read(version, ranges=_runs(with_halo)).filter(F.col(KEY).isin(series))
        rows = S.rolling_stats(P.build_panel(spine, stored, features=False), [KEY], TS, PRICE, self.window)
        return tx.add_time_features(rows.filter("_own"), TS, self.policy or tx.DEFAULT_POLICY)

    def read(self, lo=None, hi=None) -> DataFrame:
        """The panel, or a range of it (both ends included)."""
        return self.panel.read(lo=lo, hi=hi)
