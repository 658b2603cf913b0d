"""Numeric column helpers: NaN discipline, safe division, rounding."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col) -> Column:
    """NaN -> NULL (Q1): Spark's avg/max propagate NaN where pandas skips it."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def nans_to_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Apply ``nan_to_null`` to every floating column (or the given ones)."""
    floats = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or df.columns) if c in floats]
    if not cols:
        return df
    return df.withColumns({c: nan_to_null(c) for c in cols})


def is_missing(col) -> Column:
    """NULL or NaN."""
    c = _c(col)
    return c.isNull() | F.isnan(c)


def safe_div(a, b) -> Column:
    """Division that gives NULL on a zero or NULL divisor (Q7)."""
    return F.try_divide(_c(a), _c(b))


NOISE_DIGITS = 9  # sums in another order differ far beyond this decimal


def round_even(col, digits: int = 6) -> Column:
    """Round to ``digits`` decimals, half to even, after noise beyond the ninth decimal is gone.

    Plain IEEE steps on DOUBLE (``rint(x * 10^d) / 10^d``), the same in any engine. Means of
    two-decimal inputs often lie exactly half-way; without the first step the last bit of
    a sum's order would decide. NULL, NaN, infinities and values without such decimals
    stay as they are.
    """
    c = _c(col)
    fine, scale = float(10 ** max(digits, NOISE_DIGITS)), float(10 ** digits)
    rounded = F.rint(F.rint(c * F.lit(fine)) / F.lit(fine) * F.lit(scale)) / F.lit(scale)
    return F.when(F.abs(c) < F.lit(1e290), rounded).otherwise(c)  # beyond, the product overflows


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every DOUBLE column; used at report boundaries for stable output."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    if not cols:
        return df
    return df.withColumns({c: round_even(c, digits) for c in cols})


def ints_to_bigint(df: DataFrame) -> DataFrame:
    """Widen INT/SMALLINT/TINYINT columns to BIGINT at report boundaries."""
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType))]
    if not cols:
        return df
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def combine_single_rows(parts: list[DataFrame]) -> DataFrame:
    """Put several one-row results side by side without a join.

    Each part keeps its own columns (NULL elsewhere) in a by-name union, then
    one aggregate takes the non-null value of every column. Column names must
    be distinct across parts.
    """
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    cols = [c for p in parts for c in p.columns]
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
