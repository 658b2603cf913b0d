"""Key discipline: duplicates and deterministic first-wins.

Keep-first is written as an aggregate (``min_by`` over a total order), not a
``row_number`` window: the aggregate combines map-side, so a key holding a large
share of the rows is reduced before the shuffle instead of being sorted in one
task.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import join_on_keys


def _order_struct(order_cols: list[str]):
    return F.struct(*[F.col(c) for c in order_cols])


def keep_first(df: DataFrame, keys: list[str], order_cols: list[str], keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) by ``order_cols``.

    ``order_cols`` should make a total order within a key (e.g. provenance file
    name, then the value) so the result is deterministic; ties beyond it pick the
    smallest full row.
    """
    payload = [c for c in df.columns if c not in keys]
    if not payload:
        return df.select(*keys).distinct()
    pick = F.min_by if keep == "first" else F.max_by
    extra = [c for c in payload if c not in order_cols]
    best = pick(F.struct(*[F.col(c) for c in payload]), F.struct(*[F.col(c) for c in order_cols + extra]))
    out = df.groupBy(*keys).agg(best.alias("_best"))
    return out.select(*keys, *[F.col("_best")[c].alias(c) for c in payload]).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: list[str], count_col: str = "occurrences") -> DataFrame:
    """Keys seen more than once, with their count (GROUP BY ... HAVING)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).filter(F.col(count_col) > 1)


def duplicated_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Every row whose key occurs more than once (pandas ``keep=False``).

    A semi join against the duplicate-key aggregate; AQE splits a skewed key. NULL keys
    are keys like any other, as in the aggregate.
    """
    return join_on_keys(df, duplicate_keys(df, keys).select(*keys), keys, "left_semi")


def insert_or_ignore(incoming: DataFrame, target: DataFrame, keys: list[str],
                     order_cols: list[str]) -> DataFrame:
    """Rows of ``incoming`` to append so that the first write wins.

    First-wins inside the batch (``keep_first``) and against rows already stored
    (``left_anti`` on the key, NULLs equal).
    """
    first = keep_first(incoming, keys, order_cols)
    return join_on_keys(first, target.select(*keys), keys, "left_anti")
