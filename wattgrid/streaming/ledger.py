"""Loads that follow their landing files (Z1 Z2 S13): new, replaced, unchanged and vanished ones.

A file stream reads every path once, so a file replaced under its name is never seen again. Here a
ledger is kept of what landed: each look at the landing folder compares all files with it
(length and time, then a digest of the rows) and writes what happened as *arrivals* of at most
``FILES_PER_BATCH`` files each. The arrivals are the stream: a structured query over
them loads each batch into a versioned table whose rows know their file. A replaced file's rows
take the place of its old ones and a vanished file's rows go, in one commit a batch. A batch that
is repeated after a failure replaces its own rows, so nothing counts twice.

Answers are formed from the stored rows of all live files, so they equal those of a fresh load
whatever the order, the batches or the replacements were.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import nan_to_null
from ..operators.dedupe import keep_first
from ..session import scratch_path
from ..sources.versioned import VersionedTable
from .incremental import FILES_PER_BATCH, stored_table

FILE = "_file"  # a stored row's landing file
ARRIVAL = T.StructType([T.StructField(n, t) for n, t in (
    ("look", T.LongType()), ("op", T.StringType()), ("file", T.StringType()), ("path", T.StringType()),
    ("length", T.LongType()), ("modified", T.TimestampType()), ("digest", T.StringType()))])


class Ledger:
    """What has landed at ``landing`` (a folder, file or pattern of Parquet files), kept under ``name``."""

    def __init__(self, spark: SparkSession, landing: str, name: str):
        self.spark, self.landing = spark, landing
        self.base = scratch_path(spark, name)
        self.log = f"{self.base}/arrivals"

    def arrivals(self) -> DataFrame:
        """All that ever happened: ``op`` is ``load``, ``same`` (written again with equal rows) or ``gone``."""
        return stored_table(self.spark, self.log, ARRIVAL)

    def live(self) -> DataFrame:
        """The newest entry of every file that has not vanished."""
        last = self.arrivals().groupBy("file").agg(F.max_by(F.struct(*[c for c in ARRIVAL.names if c != "file"]), "look").alias("e"))
        return last.select("file", "e.*").filter("op <> 'gone'").select(*ARRIVAL.names)

    def _listed(self) -> DataFrame:
        reader = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        try:
            found = reader.load(self.landing)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], "file string, path string, length long, modified timestamp")
        return found.select(F.col("_metadata.file_path").alias("file"), "path", "length", F.col("modificationTime").alias("modified"))

    def _digests(self, paths: list[str]) -> DataFrame:
        """Per file: rows and an order-free sum of row hashes."""
        rows = self.spark.read.parquet(*paths)
        h = F.xxhash64(*rows.columns).cast("decimal(20,0)")
        return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.concat_ws(":", F.count(F.lit(1)), F.sum(h)).alias("digest"))

    def look(self) -> int:
        """Compare the landing folder with the ledger and log what happened; how many entries that made."""
        known = self.live().select("file", F.col("path").alias("_path"), F.col("length").alias("_length"), F.col("modified").alias("_modified"), F.col("digest").alias("_digest"))
        both = self._listed().join(known, "file", "full")
        changed = both.filter("_path IS NULL OR path IS NULL OR length <> _length OR modified <> _modified").cache()
        try:
            paths = [r["path"] for r in changed.filter("path IS NOT NULL").select("path").collect()]  # names, as any scan lists them
            digests = self._digests(paths) if paths else self.spark.createDataFrame([], "file string, digest string")
            entries = changed.join(digests, "file", "left")
            n = self.arrivals().agg(F.max("look")).first()[0] or 0
            op = F.when(F.col("path").isNull(), "gone").when(F.col("digest").eqNullSafe(F.col("_digest")) & F.col("_path").isNotNull(), "same").otherwise("load")
            entries = entries.select(F.lit(n + 1).cast("long").alias("look"), op.alias("op"), "file", F.coalesce("path", "_path").alias("path"),
                                     F.coalesce("length", "_length").alias("length"), F.coalesce("modified", "_modified").alias("modified"), F.coalesce("digest", "_digest").alias("digest"))
            count = changed.count()
            if count:
                # a shuffle of the few entries: coalesce would have one task run the joins of all partitions
                dealt = entries.repartition(max(1, count // (FILES_PER_BATCH * 16)), "file")
                dealt.write.mode("append").option("maxRecordsPerFile", FILES_PER_BATCH).parquet(self.log)
            return count
        finally:
            changed.unpersist()


def follow(spark: SparkSession, landing: str, transform: Callable[[DataFrame], DataFrame], row_schema: T.StructType, name: str,
           source_schema: T.StructType | None = None) -> DataFrame:
    """Bring the stored rows under ``name`` up to date with ``landing``; all of them, with their file in ``_file``.

    ``transform`` gets the rows of some landing files with their ``_file`` and must treat each file by
    itself: keep ``_file``, and drop no row on account of another file's.
    """
    ledger = Ledger(spark, landing, name)
    table = VersionedTable(spark, f"{ledger.base}/rows", T.StructType([T.StructField(FILE, T.StringType()), *row_schema.fields]), FILE)
    ledger.look()

    def load(batch: DataFrame, batch_id: int) -> None:
        entries = [r for r in batch.collect() if r["op"] != "same"]  # FILES_PER_BATCH at most
        if not entries:
            return
        files, paths = sorted(r["file"] for r in entries), [r["path"] for r in entries if r["op"] == "load"]
        rows = None
        if paths:
            reader = spark.read.schema(source_schema) if source_schema else spark.read
            rows = transform(reader.parquet(*paths).withColumn(FILE, F.col("_metadata.file_path")))
        table.replace_where(F.col(FILE).isin(files), rows, files[0], files[-1], {"batch": batch_id})

    if stored_table(spark, ledger.log, ARRIVAL).isEmpty():
        return table.read()
    stream = spark.readStream.schema(ARRIVAL).option("maxFilesPerTrigger", 1).parquet(ledger.log)
    q = stream.writeStream.foreachBatch(load).option("checkpointLocation", f"{ledger.base}/checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()
    return table.read()


def follow_first_wins(spark: SparkSession, landing: str, transform: Callable[[DataFrame], DataFrame], row_schema: T.StructType, keys: list[str],
                      order_cols: list[str], name: str, source_schema: T.StructType | None = None) -> DataFrame:
    """Of every key the first row by ``order_cols`` among all live files. Losing rows stay stored, so they
    come to light when the winner's file is replaced or vanishes."""
    def per_file(df: DataFrame) -> DataFrame:
        return keep_first(transform(df), [FILE, *keys], order_cols)
    rows = follow(spark, landing, per_file, row_schema, name, source_schema)
    return keep_first(rows, keys, order_cols).select(*row_schema.names)


def follow_totals(spark: SparkSession, landing: str, prepare: Callable[[DataFrame], DataFrame], group_schema: T.StructType, value_col: str,
                  name: str, source_schema: T.StructType | None = None) -> DataFrame:
    """Z2, exact: per group count of rows, sum and mean of a value over all live files. Stored are each file's
    partial sums; NaN is skipped like NULL."""
    groups = group_schema.names
    partial = T.StructType([*group_schema.fields, T.StructField("n", T.LongType()), T.StructField("n_values", T.LongType()), T.StructField("total", T.DoubleType())])

    def per_file(df: DataFrame) -> DataFrame:
        v = nan_to_null(value_col)
        return prepare(df).groupBy(FILE, *groups).agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("n_values"), F.sum(v).alias("total"))
    rows = follow(spark, landing, per_file, partial, name, source_schema)
    total = F.sum("total")
    return rows.groupBy(*groups).agg(F.sum("n").alias("n"), total.alias("total"), F.try_divide(total, F.sum("n_values")).alias("mean"))
