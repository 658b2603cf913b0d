"""Joins on keys that may be NULL."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join by null-safe equality on ``keys``; the result has the left side's keys once.

    A NULL key is a group like any other, as in GROUP BY. Without keys every row meets
    every row, so that is refused.
    """
    if not keys:
        raise ValueError("a join needs at least one key")
    named = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(named[f"_r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(named, cond, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{k}" for k in keys])
