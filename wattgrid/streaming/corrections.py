"""Event-time windows that close, and corrections for what comes later.

Every run over a stream of files adds partial sums per window and key. A window stays *open* until the
watermark (the latest event time of earlier runs, less a delay) passes its end; the closing pass at
the end of a run then turns its open parts into one *closed* row, its final report. Rows that arrive for a window whose end the
watermark has passed are not lost: their partial sums are stored as *late*, in a row of the run's batch. So

    closed (or open) + late = exact totals, whatever the order of files and however late rows are.

All three kinds live in one versioned table, so a batch or a closing pass is one commit; a batch that
is repeated after a failure is known by the number in the last commit and skipped. The state that is
rewritten is the open windows alone: their files are found by the time up to which they are open.
The watermark moves between runs only, so results do not depend on how a run's files fall into batches.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecols as tc
from ..functions.numeric import nan_to_null
from ..session import scratch_path
from ..sources.versioned import VersionedTable
from .incremental import FILES_PER_BATCH

BEGINNING = dt.datetime(1, 1, 2)  # closed and late rows have no time up to which they are open, so no range holds them
SUMS = ["n", "n_values", "total"]


class CorrectedWindows:
    """Hourly totals of ``value_col`` per key of the rows that ``prepare`` makes of a stream (``event_time`` in
    TIMESTAMP_NTZ, ``keys``, the value), kept under ``name``. Rows without a time have no window; NaN is skipped like NULL."""

    def __init__(self, spark: SparkSession, name: str, event_time: str, keys: T.StructType, value_col: str,
                 delay_hours: int = 2, prepare: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.base = spark, scratch_path(spark, name)
        self.event_time, self.keys, self.value_col = event_time, keys.names, value_col
        self.delay, self.prepare = dt.timedelta(hours=delay_hours), prepare or (lambda df: df)
        ntz = T.TimestampNTZType()
        schema = T.StructType([T.StructField("window_start", ntz), *keys.fields, T.StructField("n", T.LongType()), T.StructField("n_values", T.LongType()),
                               T.StructField("total", T.DoubleType()), T.StructField("kind", T.StringType()), T.StructField("batch", T.LongType()),
                               T.StructField("open_until", ntz)])
        self.table = VersionedTable(spark, f"{self.base}/windows", schema, "open_until")

    def _state(self) -> dict:
        """The last commit's notes: ``batch``, ``seen`` (latest event time of all batches), ``watermark``."""
        v = self.table.latest()
        notes = self.table.commit_of(v) if v else {}
        return {k: notes.get(k) for k in ("batch", "seen", "watermark")}

    def _add(self, batch: DataFrame, number: int) -> None:
        state = self._state()
        if state["batch"] is not None and number <= state["batch"]:
            return  # this batch was committed before a failure
        rows = self.prepare(batch).filter(F.col(self.event_time).isNotNull())
        v = nan_to_null(self.value_col)
        parts = rows.groupBy(tc.trunc_hour(self.event_time).alias("window_start"), *self.keys).agg(
            F.count(F.lit(1)).alias("n"), F.count(v).alias("n_values"), F.sum(v).alias("total"), F.max(self.event_time).alias("_last"))
        staged = f"{self.base}/batches/{number}"
        parts.write.mode("overwrite").parquet(staged)  # looked at three times below
        parts = self.spark.read.schema(parts.schema).parquet(staged)
        last = parts.agg(F.max("_last")).first()[0]
        seen = max(x for x in (state["seen"], last.isoformat() if last else None, "") if x is not None) or None
        end = tc.add_hours("window_start", 1)
        past = end <= F.lit(state["watermark"]).cast("timestamp_ntz") if state["watermark"] else F.lit(False)
        parts = parts.drop("_last").withColumn("batch", F.lit(number).cast("long"))
        late = parts.filter(past).withColumns({"kind": F.lit("late"), "open_until": F.lit(None).cast("timestamp_ntz")})
        open_ = parts.filter(~past).withColumns({"kind": F.lit("open"), "open_until": end})
        self.table.replace_where(None, [late, open_], notes={"batch": number, "seen": seen, "watermark": state["watermark"]}, always=True)

    def _close(self, everything: bool) -> None:
        """The closing pass: move the watermark, make one closed row of each window that it passed, one open row of each other."""
        state = self._state()
        if not state["seen"]:
            return
        mark = (dt.datetime.fromisoformat(state["seen"]) - self.delay).isoformat()
        mark = max(mark, state["watermark"] or "")
        merged = self.table.read(lo=BEGINNING).groupBy("window_start", *self.keys, "open_until").agg(
            *[F.sum(c).alias(c) for c in SUMS], F.max("batch").alias("batch"))
        passed = F.lit(True) if everything else F.col("open_until") <= F.lit(mark).cast("timestamp_ntz")
        closed = merged.filter(passed).withColumns({"kind": F.lit("closed"), "open_until": F.lit(None).cast("timestamp_ntz")})
        still = merged.filter(~passed).withColumn("kind", F.lit("open"))
        if everything:  # windows that nobody saw yet are past as well
            mark = max(mark, (dt.datetime.fromisoformat(state["seen"]) + dt.timedelta(hours=1)).replace(minute=0, second=0, microsecond=0).isoformat())
        self.table.replace_where(F.lit(True), [closed, still], lo=BEGINNING, notes={**state, "watermark": mark}, always=True)

    def run(self, stream: DataFrame, close_all: bool = False) -> None:
        """Add what has landed since the last run, then close what the watermark passes (``close_all``: every window)."""
        q = stream.writeStream.foreachBatch(self._add).option("checkpointLocation", f"{self.base}/checkpoint").trigger(availableNow=True).start()
        q.awaitTermination()
        self._close(close_all)

    def rows(self) -> DataFrame:
        """All stored sums: ``kind`` is ``open`` (preliminary), ``closed`` (reported once) or ``late`` (a correction)."""
        return self.table.read().drop("open_until")

    def totals(self) -> DataFrame:
        """Per window and key: exact ``n``, ``total`` and ``mean``, what of them came late, and whether the window is closed."""
        late = F.col("kind") == "late"
        return self.rows().groupBy("window_start", *self.keys).agg(
            F.sum("n").alias("n"), F.sum("total").alias("total"), F.try_divide(F.sum("total"), F.sum("n_values")).alias("mean"),
            F.sum(F.when(late, F.col("n")).otherwise(0)).alias("n_late"), F.sum(F.when(late, F.col("total"))).alias("total_late"),
            (F.count_if(F.col("kind") == "open") == 0).alias("closed"))


def file_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stream of the Parquet files at ``path`` in batches of bounded size."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(path)
