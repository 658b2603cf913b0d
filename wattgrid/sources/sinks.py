"""Sinks (S5-S10): append, overwrite, predicate delete, insert-or-ignore, panel, CSV.

Tables are Parquet folders. Every write selects columns *by name* against the
declared schema first (inserts in the reference are positional, so a reordered
frame would corrupt silently).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import insert_or_ignore
from ..schemas import conform
from ..session import read_once


def append(df: DataFrame, path: str, schema: T.StructType, partition_by: list[str] | None = None) -> None:
    """Append rows, conformed by name."""
    w = conform(df, schema).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite(df: DataFrame, path: str, schema: T.StructType, partition_by: list[str] | None = None) -> None:
    """Truncate-and-reload."""
    w = conform(df, schema).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def delete_where(spark: SparkSession, path: str, predicate: Column, out_path: str) -> DataFrame:
    """The table without the rows matching ``predicate``, written to ``out_path``.

    The complement is NULL-safe (``NOT (p <=> true)``): a row where the
    predicate is NULL is kept, as SQL ``DELETE`` keeps it. Parquet folders
    cannot be rewritten in place while being read, so the result goes to a
    new folder (swap it in afterwards), then is returned.
    """
    src = spark.read.parquet(path)
    keep = src.filter(~predicate.eqNullSafe(F.lit(True)))
    keep.write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def append_ignore(spark: SparkSession, incoming: DataFrame, path: str, schema: T.StructType,
                  keys: list[str], order_cols: list[str], range_col: str | None = "timestamp") -> None:
    """Insert-or-ignore: first write wins on key, within the batch and
    against stored rows (read as the anti-join side).

    With ``range_col`` the stored side is read only for the batch's
    ``[min, max]`` range (one-row bounds, pushed to the scan and to partition
    pruning), not in full. The batch is written once, so the bounds are those of the rows appended.
    """
    from ..streaming.incremental import stored_table
    target = stored_table(spark, path, schema)
    cols = [c for c in dict.fromkeys(schema.names + list(order_cols)) if c in incoming.columns]
    inc = incoming.select(*cols)
    if range_col and range_col in inc.columns:
        inc = read_once(inc, "incoming")
        b = inc.agg(F.min(range_col).alias("lo"), F.max(range_col).alias("hi")).first()
        if b["lo"] is None:
            return
        target = target.filter(F.col(range_col).between(F.lit(b["lo"]), F.lit(b["hi"])))
    append(insert_or_ignore(inc, target, keys, order_cols), path, schema)


def write_panel(panel: DataFrame, path: str, timestamp_col: str = "timestamp", key_col: str = "country",
                compression: str = "snappy", num_files: int | None = None) -> None:
    """Snappy Parquet partitioned by year, sorted by (country, time) within files.

    Rows are range-partitioned on (year, country, time) first, so files are
    balanced and each covers a contiguous stretch of one series (tight min/max
    statistics for row-group skipping); a year is never written by one task.
    """
    out = panel.withColumn("year", F.year(timestamp_col)) if "year" not in panel.columns else panel
    n = num_files or int(panel.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = out.repartitionByRange(n, "year", key_col, timestamp_col).sortWithinPartitions(key_col, timestamp_col)
    out.write.mode("overwrite").option("compression", compression).partitionBy("year").parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header, one file per partition. ``single_file`` is for small summary
    tables (8 and 24 rows): a shuffle of the finished rows, so the work before it keeps
    its parallelism."""
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
