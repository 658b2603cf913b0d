"""Column-level helpers (built-in Spark expressions only, no UDFs)."""
from .numeric import (ints_to_bigint, is_missing, nan_to_null, nans_to_nulls,  # noqa: F401
                      round_doubles, safe_div)
from .timecols import (add_hours, calendar_columns, day_range, day_type,  # noqa: F401
                       from_hour_number, hour_number, in_window, instant_to_utc_ntz,
                       local_to_utc, month_label, ntz, phase2, phase3, phase_by_start,
                       seconds_between, time_range, trunc_day, trunc_hour, trunc_month)
