"""Stored value counts from which quantiles of any range of days follow.

Each batch of rows is stored once as counts per series, day and value. Counts of days add up, so
the quantiles of any range come from the counts of its days alone: exact, or, with a
``resolution``, within half of it. The panel is not read again.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import join_on_keys
from ..functions.numeric import is_missing
from ..operators import series as S
from ..operators import stats as A


def _month(day: Column) -> Column:
    """Months since the year 0."""
    return F.year(day) * 12 + F.month(day) - 1


class QuantileState:
    """Value counts per ``keys``, day and value in ``folder``, a folder a batch, by month.

    ``resolution`` None keeps every distinct value; otherwise values count at the middle of their step of that
    width, which bounds the stored rows a day and moves no quantile by more than half a step.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], timestamp_col: str = "timestamp",
                 value_col: str = "value", resolution: float | None = None):
        if resolution is not None and not resolution > 0:
            raise ValueError("resolution must be above 0")
        self.spark, self.folder, self.keys = spark, folder.rstrip("/"), list(keys)
        self.timestamp_col, self.value_col, self.resolution = timestamp_col, value_col, resolution

    def add(self, df: DataFrame, batch: str) -> None:
        """Store a batch's counts. A batch added again under its name replaces itself, so a retried job counts
        nothing twice. Rows without a time or value (NULL or NaN) are left out; NULL keys are a series of their own."""
        v = F.col(self.value_col).cast("double")
        if self.resolution is not None:
            v = (F.floor(v / self.resolution) + 0.5) * self.resolution
        rows = df.filter(F.col(self.timestamp_col).isNotNull() & ~is_missing(self.value_col))
        day = F.to_date(self.timestamp_col)
        counts = rows.groupBy(*self.keys, day.alias("_day"), v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        counts = counts.withColumn("_month", _month(F.col("_day")))
        counts.write.mode("overwrite").partitionBy("_month").parquet(f"{self.folder}/_batch={batch}")

    def counts(self, start=None, end=None) -> DataFrame:
        """Keys, ``_v`` and ``_n`` over the days from ``start`` to before ``end``; other months are not read."""
        d = self.spark.read.parquet(self.folder)
        if start is not None:
            day = F.lit(str(start)[:10]).cast("date")
            d = d.filter((F.col("_day") >= day) & (F.col("_month") >= _month(day)))
        if end is not None:
            day = F.lit(str(end)[:10]).cast("date")
            d = d.filter((F.col("_day") < day) & (F.col("_month") <= _month(day)))
        return d.groupBy(*self.keys, "_v").agg(F.sum("_n").alias("_n"))

    def quantiles(self, probs: dict[str, float], start=None, end=None) -> DataFrame:
        """Keys, ``n`` and the named, linearly interpolated quantiles of a range of days; series without values in it give no row."""
        counts = self.counts(start, end)
        ranks = S.prefix_sum(counts, self.keys, "_v", "_n", out_col="rank_first", total_col="n_total")
        found = A.rank_lookup(ranks, self.keys, list(probs.values()), list(probs))
        total = counts.groupBy(*self.keys).agg(F.sum("_n").alias("n"))
        return join_on_keys(total, found, self.keys).select(*self.keys, "n", *probs)
