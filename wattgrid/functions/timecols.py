"""Column expressions for time handling (TIMESTAMP_NTZ, session-zone independent).

All hour arithmetic goes through ``timestamp_diff`` / ``timestamp_add`` on NTZ
values, which Spark evaluates in UTC whatever the session zone is. ``date_trunc``
is avoided on NTZ input because it returns a zone-dependent TIMESTAMP.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "1970-01-01 00:00:00"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz(value: str | _dt.datetime | _dt.date) -> Column:
    """A TIMESTAMP_NTZ literal."""
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_ntz() -> Column:
    return ntz(EPOCH)


def hour_number(col) -> Column:
    """Whole hours since 1970-01-01 00:00 as BIGINT, rounded down on either side of it
    (``timestamp_diff`` alone rounds towards it)."""
    micros = F.timestamp_diff("MICROSECOND", epoch_ntz(), _c(col))
    hour = F.lit(3_600_000_000)
    return ((micros - F.pmod(micros, hour)) / hour).cast("bigint")  # a whole multiple: exact


def from_hour_number(col) -> Column:
    return F.timestamp_add("HOUR", _c(col), epoch_ntz())


def add_hours(col, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else _c(n)
    return F.timestamp_add("HOUR", n, _c(col))


def seconds_between(a, b) -> Column:
    """Signed ``b - a`` in seconds (BIGINT)."""
    return F.timestamp_diff("SECOND", _c(a), _c(b))


def trunc_hour(col) -> Column:
    return from_hour_number(hour_number(col))


def trunc_day(col) -> Column:
    """Start of the day as NTZ (T10, returns NTZ unlike ``date_trunc``)."""
    return F.to_date(_c(col)).cast("timestamp_ntz")


def trunc_month(col) -> Column:
    return F.trunc(F.to_date(_c(col)), "month").cast("timestamp_ntz")


def instant_to_utc_ntz(col) -> Column:
    """TIMESTAMP (an instant) -> its UTC wall time as NTZ, without a lossy cast.

    ``unix_micros`` reads the instant itself, so this is exact even where a cast
    through a DST-observing session zone would merge two instants (autumn change).
    """
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), epoch_ntz())


def local_to_utc(col, tz: str) -> Column:
    """NTZ wall time in zone ``tz`` -> NTZ wall time in UTC."""
    if tz.upper() == "UTC":
        return _c(col)
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), _c(col))


def time_range(col, start, end) -> Column:
    """Half-open ``start <= col < end`` (P2); pushes both bounds to Parquet."""
    return (_c(col) >= ntz(start)) & (_c(col) < ntz(end))


def day_range(col, day) -> Column:
    """Rewrite of ``date_trunc('day', col) = day`` (P3) as a pushable range."""
    d = _dt.date.fromisoformat(str(day)[:10])
    return time_range(col, d, d + _dt.timedelta(days=1))


def parse_timestamp(col, formats: tuple[str, ...] = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss",
                                                   "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "dd/MM/yyyy")) -> Column:
    """Heterogeneous date/time strings to NTZ; the first format that parses
    wins, unparseable values give NULL (``try_to_timestamp``, never an error).

    The parsed value is rendered back as text in the session zone and read as
    NTZ, so the wall-clock fields are kept whatever the session zone.
    """
    c = _c(col).cast("string")
    return F.coalesce(*[F.to_timestamp_ntz(F.try_to_timestamp(c, F.lit(f)).cast("string")) for f in formats])


# ---- calendar features (T4) ----------------------------------------------

def calendar_columns(col) -> dict[str, Column]:
    """Calendar parts; day_of_week is Monday=0 (``weekday``, not ``dayofweek``)."""
    c = _c(col)
    dow = F.weekday(c)
    return {
        "hour": F.hour(c),
        "day_of_week": dow,
        "month": F.month(c),
        "year": F.year(c),
        "quarter": F.quarter(c),
        "day_of_year": F.dayofyear(c),
        "is_weekend": dow >= 5,
    }


def in_window(col, start, end) -> Column:
    """Policy flag (T5): both ends inclusive; ``end`` a date means through 23:59:59."""
    end_s = str(end)
    if len(end_s) == 10:
        end_s = end_s + " 23:59:59"
    return _c(col).between(ntz(start), ntz(end_s))


def phase2(flag) -> Column:
    """Pre / during by flag (T6). A NULL flag stays NULL (falls out of both)."""
    f = _c(flag)
    return F.when(f, F.lit("during")).when(~f, F.lit("pre"))


def phase_by_start(col, start) -> Column:
    """Pre / during by policy start only (T7): rows after the end count as during."""
    c = _c(col)
    return F.when(c < ntz(start), F.lit("pre")).when(c >= ntz(start), F.lit("during"))


def phase3(col, start, end) -> Column:
    """Before / during / after (T8); ``end`` inclusive as in ``in_window``."""
    end_s = str(end)
    if len(end_s) == 10:
        end_s = end_s + " 23:59:59"
    c = _c(col)
    return (F.when(c < ntz(start), F.lit("before"))
            .when(c <= ntz(end_s), F.lit("during"))
            .when(c.isNotNull(), F.lit("after")))


def day_type(flag) -> Column:
    """Two-way label from a boolean (P10), NULL preserved."""
    f = _c(flag)
    return F.when(f, F.lit("Weekend")).when(~f, F.lit("Weekday"))


def month_label(col) -> Column:
    """``strftime('%b %y')`` style label, e.g. ``Jun 22``."""
    return F.date_format(_c(col), "MMM yy")
