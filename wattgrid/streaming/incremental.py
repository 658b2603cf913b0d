"""Structured Streaming re-aims.

The reference lands files in chunks and loads them with insert-or-ignore; here
the same contracts run as streaming queries whose progress lives in a
checkpoint under the cluster's shared ``spark.checkpoint.dir``, under a name that
the caller gives: a job started again under that name resumes from its last
committed batch. Exact answers (``incremental_first_wins``, ``incremental_totals``) do not
depend on how files fall into batches and lose no late row; the watermarked forms
bound their state and give up later rows by design.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc
from ..functions.numeric import nan_to_null
from ..operators.dedupe import insert_or_ignore
from ..schemas import conform
from ..session import read_once, scratch_path


FILES_PER_BATCH = 64  # a batch holds a bounded part of what has landed


def stored_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one if nothing is there yet. Any other failure
    to read (permissions, corrupt files, timeouts) is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def incremental_first_wins(spark: SparkSession, landing: str, source_schema: T.StructType,
                           transform, target: str, target_schema: T.StructType, keys: list[str],
                           order_cols: list[str], checkpoint_name: str,
                           max_files_per_trigger: int = FILES_PER_BATCH, range_col: str | None = "timestamp"):
    """Load new landing files as they arrive; first write wins on key.

    Each micro-batch is transformed (e.g. ``load_wide_prices``), deduplicated
    inside the batch, anti-joined against the stored table and appended
    (``foreachBatch`` + S8). Re-running a batch after a failure appends nothing
    twice, because rows whose key is already stored are ignored. Runs with the
    ``availableNow`` trigger: process what has landed, then stop.
    """
    stream = spark.readStream.schema(source_schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(landing)
    if "source" not in source_schema.names:
        stream = stream.withColumn("source", F.col("_metadata.file_path"))

    def load(batch: DataFrame, batch_id: int) -> None:
        incoming = read_once(transform(batch), "batch") if range_col else transform(batch)
        stored = stored_table(spark, target, target_schema)
        if range_col:
            # One-row bounds of this batch; the stored side is read only for that
            # range (pushed to the Parquet scan), not in full on every batch.
            lo_hi = incoming.agg(F.min(range_col).alias("lo"), F.max(range_col).alias("hi")).first()
            if lo_hi["lo"] is None:
                return
            stored = stored.filter(F.col(range_col).between(F.lit(lo_hi["lo"]), F.lit(lo_hi["hi"])))
        new = insert_or_ignore(incoming, stored, keys, order_cols)
        conform(new, target_schema).write.mode("append").parquet(target)

    q = (stream.writeStream.foreachBatch(load)
         .option("checkpointLocation", scratch_path(spark, checkpoint_name))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def incremental_totals(spark: SparkSession, stream: DataFrame, group_cols: list[str], value_col: str, name: str) -> DataFrame:
    """Z2, exact: per group count of rows, sum and mean of a value over a stream of files.

    Each batch is summed map-side and its partial sums are written under its batch number
    (a repeated batch replaces its own); reading adds the partial sums up. No state is
    held, open windows and late rows count like any others, and neither batch layout nor a
    restart changes the answer. NaN is skipped like NULL. ``stream`` is read with the
    file source's ``maxFilesPerTrigger``.
    """
    base = scratch_path(spark, name)
    v = nan_to_null(value_col)

    def add(batch: DataFrame, batch_id: int) -> None:
        part = batch.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("n_values"), F.sum(v).alias("total"))
        part.write.mode("overwrite").parquet(f"{base}/parts/batch={batch_id}")

    q = (stream.writeStream.foreachBatch(add).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    schema = T.StructType([stream.schema[c] for c in group_cols] + [T.StructField("n", T.LongType()), T.StructField("n_values", T.LongType()), T.StructField("total", T.DoubleType())])
    total = F.sum("total")
    return stored_table(spark, f"{base}/parts", schema).groupBy(*group_cols).agg(
        F.sum("n").alias("n"), total.alias("total"), F.try_divide(total, F.sum("n_values")).alias("mean"))


def dedupe_within_watermark(stream: DataFrame, event_time: str, keys: list[str], delay: str) -> DataFrame:
    """Z1 (bounded lateness): drop repeats of a key arriving within ``delay``.

    State is kept only for the watermark delay; use ``incremental_first_wins``
    when a file can overlap arbitrarily old data.
    """
    s = stream.withColumn("_et", F.col(event_time).cast("timestamp"))
    return s.withWatermark("_et", delay).dropDuplicatesWithinWatermark(keys).drop("_et")


def hourly_window_aggregate(stream: DataFrame, event_time: str, key_col: str, value_col: str,
                            delay: str = "2 hours", window: str = "1 hour") -> DataFrame:
    """Per key and tumbling hour: count, sum, mean, with late data bounded.

    Event time must be a TIMESTAMP for watermarking (NTZ is rejected), so the
    NTZ column is read as UTC (session zone pinned) and the window bounds are
    returned as NTZ UTC wall time. Append mode emits a window once the
    watermark (max event time - ``delay``) passes its end; rows later than that
    are dropped by design.
    """
    s = stream.withColumn("_et", F.col(event_time).cast("timestamp")).withWatermark("_et", delay)
    v = nan_to_null(value_col)
    agg = s.groupBy(F.window("_et", window).alias("w"), F.col(key_col)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(v).alias("total"), F.avg(v).alias("mean"))
    return agg.select(tc.instant_to_utc_ntz(F.col("w.start")).alias("window_start"),
                      tc.instant_to_utc_ntz(F.col("w.end")).alias("window_end"), key_col, "n", "total", "mean")


def run_to_table(spark: SparkSession, stream_df: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Run a streaming DataFrame with ``availableNow`` into Parquet under the
    shared checkpoint folder and return the written table as a batch DataFrame.
    Windows still open at the end stay in the checkpoint's state and are written when a
    later run under the same ``name`` moves the watermark past them."""
    base = scratch_path(spark, name)
    q = (stream_df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", base + "/_checkpoint").option("path", base + "/out")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream_df.schema).parquet(base + "/out")
