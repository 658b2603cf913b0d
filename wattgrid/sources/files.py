"""File sources (S1-S3, S13-S15): Parquet scans with provenance and schemas.

Every reader returns a lazy DataFrame; filters applied afterwards reach the
Parquet scan (``PushedFilters``) and only the selected columns are read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc
from ..functions.numeric import nans_to_nulls
from ..schemas import WIDE_PRICES, conform


def _date_of(df: DataFrame, col: str) -> Column:
    """A DATE from whatever a file holds: date, timestamp (zoned or not) or text."""
    t = df.schema[col].dataType
    if isinstance(t, T.DateType):
        return F.col(col)
    if isinstance(t, T.TimestampType):
        return F.to_date(tc.instant_to_utc_ntz(col))
    if isinstance(t, T.TimestampNTZType):
        return F.to_date(col)
    return F.to_date(tc.parse_timestamp(col))


def read_wide_prices(spark: SparkSession, path: str | list[str], schema: T.StructType = WIDE_PRICES,
                     ignore_corrupt: bool = False) -> DataFrame:
    """S1 + S2: wide price files (``DATE, CONCEPT, H1..H24[, H25]``) with provenance.

    Files are read with the types they have and then brought to ``schema`` by name: ``DATE``
    may be a date, a timestamp or text in any of ``parse_timestamp``'s forms, hours may be
    integers, a missing ``H25`` (or any hour) reads as NULL. Give paths whose files
    differ in a column's type as a list; each is read by itself. ``source`` is the
    file's full path (``_metadata.file_path``): it sorts like a sorted glob, is unique
    across folders, and is the deterministic tie-break for first-wins loading. NaN
    becomes NULL (Q1). ``ignore_corrupt`` skips unreadable files instead of failing (Q18).
    """
    r = spark.read.option("mergeSchema", "true")
    if ignore_corrupt:
        r = r.option("ignoreCorruptFiles", "true")
    out = None
    for one in ([path] if isinstance(path, str) else list(path)):
        df = r.parquet(one)
        if "DATE" in df.columns:
            df = df.withColumn("DATE", _date_of(df, "DATE"))
        df = conform(df.withColumn("source", F.col("_metadata.file_path")), T.StructType([*schema.fields, T.StructField("source", T.StringType())]))
        out = df if out is None else out.unionByName(df)
    return nans_to_nulls(out)


def read_panel(spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
               timestamp_col: str = "timestamp", partition_col: str = "year") -> DataFrame:
    """S3: a stored panel, optionally restricted to a half-open time range.

    The range is written as ``>= start AND < end`` so it is pushed to the
    Parquet reader (row-group skipping), and, when the panel is partitioned by
    ``year`` (``sinks.write_panel``), the implied year bounds prune whole
    partition folders before any file is opened.
    """
    import datetime as _dt

    from ..functions.timecols import time_range
    df = spark.read.parquet(path)
    if start is not None and end is not None:
        cond = time_range(timestamp_col, start, end)
        if partition_col in df.columns:
            y0 = _dt.date.fromisoformat(str(start)[:10]).year
            last = _dt.datetime.fromisoformat(str(end)) - _dt.timedelta(microseconds=1)
            cond = cond & F.col(partition_col).between(y0, last.year)
        df = df.filter(cond)
    return df


def normalise_long(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Rename source columns to the table's names, then conform by name."""
    if renames:
        df = df.withColumnsRenamed(renames)
    return nans_to_nulls(conform(df, schema))


def file_inventory(spark: SparkSession, path: str, timestamp_col: str | None = None,
                   date_col: str | None = None, glob: str = "*.parquet") -> DataFrame:
    """S13 (+ Q18): one row per landed file: path, name, size, modification
    time, rows, time range, distinct dates, and whether it gave no rows.

    Files are listed by the ``binaryFile`` source (metadata only, the content
    column is pruned) and left-joined with one Parquet scan grouped by
    ``_metadata.file_path``, so an empty file still appears (``rows = 0``).
    No per-file loop and nothing collected.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "true").load(path)
               .select(F.col("path").alias("file_path"), F.col("length").alias("file_size"),
                       F.col("modificationTime").alias("modified")))
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    aggs = [F.count(F.lit(1)).alias("rows")]
    if timestamp_col:
        aggs += [F.min(timestamp_col).alias("first"), F.max(timestamp_col).alias("last")]
    d = date_col or timestamp_col
    if d:
        aggs.append(F.count_distinct(F.to_date(d)).alias("distinct_dates"))
    per_file = df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(*aggs)
    out = listing.join(per_file, "file_path", "left")
    return out.withColumns({"file_name": F.regexp_extract("file_path", r"([^/]+)$", 1),
                            "rows": F.coalesce("rows", F.lit(0)),
                            "empty": F.coalesce("rows", F.lit(0)) == 0})


def arrival_coverage(df: DataFrame, date_col: str, months: int = 3, start: str | None = None, end: str | None = None) -> DataFrame:
    """Which expected acquisition windows (every ``months`` months) have data, and how much.

    ``start`` and ``end`` give the expected calendar; windows in it without data get 0, and
    windows with data outside it are reported with ``expected`` false. Without them the
    calendar reaches from the first to the last landed window. Landed dates are mapped
    to their window start arithmetically (an equi-join key); one scan.
    """
    d = df.select(F.to_date(date_col).alias("_d")).filter(F.col("_d").isNotNull()).distinct()

    def window_start(col: Column) -> Column:
        m = F.floor((F.year(col) * 12 + F.month(col) - 1) / months) * months
        return F.make_date((m / 12).cast("int"), (F.pmod(m, F.lit(12)) + 1).cast("int"), F.lit(1))

    landed = d.groupBy(window_start(F.col("_d")).alias("window_start")).agg(F.count(F.lit(1)).alias("days_landed"))
    step = F.expr(f"INTERVAL {months} MONTH")
    if start and end:
        one = df.sparkSession.range(1)
        calendar = one.select(F.explode(F.sequence(window_start(F.lit(start).cast("date")), window_start(F.lit(end).cast("date")), step)).alias("window_start"))
    else:
        b = landed.agg(F.min("window_start").alias("_lo"), F.max("window_start").alias("_hi")).filter("_lo IS NOT NULL")
        calendar = b.select(F.explode(F.sequence("_lo", "_hi", step)).alias("window_start"))
    out = calendar.withColumn("expected", F.lit(True)).join(landed, "window_start", "full_outer")
    last = F.date_sub(F.add_months("window_start", months), 1)
    label = F.concat(F.year("window_start").cast("string"), F.lit("Q"), F.quarter("window_start").cast("string")) \
        if months == 3 else F.date_format("window_start", "yyyy-MM")
    return out.select("window_start", last.alias("window_end"), label.alias("label"),
                      F.datediff(F.add_months("window_start", months), F.col("window_start")).cast("bigint")
                      .alias("days_expected"),
                      F.coalesce("days_landed", F.lit(0)).alias("days_landed"), F.coalesce("expected", F.lit(False)).alias("expected"))
