"""Streams that follow their landing files: replaced, equal, vanished and late ones, repeated batches."""
import datetime as dt
import os
import re
import uuid

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattgrid.plans import registry
from wattgrid.streaming import ledger as L

T0 = dt.datetime(2024, 1, 1)
GROUPS = T.StructType([T.StructField("k", T.StringType())])
ROW = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.DoubleType()), T.StructField("source", T.StringType())])


def put(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(pa.table({"k": pa.array([r[0] for r in rows], pa.string()), "v": pa.array([r[1] for r in rows], pa.float64())}), path)


def totals(spark, landing, name):
    got = L.follow_totals(spark, landing, lambda df: df.select(L.FILE, "k", "v"), GROUPS, "v", name)
    return sorted((r["k"] or "", r["n"], r["total"], r["mean"]) for r in got.collect())


def first(spark, landing, name):
    got = L.follow_first_wins(spark, landing, lambda df: df.withColumn("source", F.regexp_extract(L.FILE, r"([^/]+)$", 1)), ROW, ["k"], ["source", "v"], name)
    return sorted((r["k"] or "", str(r["v"]), r["source"]) for r in got.collect())


def ops(spark, landing, name):
    return sorted((r["look"], r["op"], r["file"].rsplit("/", 1)[1]) for r in L.Ledger(spark, landing, name).arrivals().collect())


@pytest.mark.parametrize("answer", [totals, first])
def test_follows_every_change(spark, tmpdir_path, answer):
    land, name = tmpdir_path + "/land", "follow-" + uuid.uuid4().hex
    assert answer(spark, land, name) == []
    steps = [
        lambda: put(f"{land}/b.parquet", [("x", 1.0), ("y", 2.0), (None, float("nan")), ("x", 5.0)]),
        lambda: put(f"{land}/deep/a.parquet", [("x", 10.0), ("z", None)]),           # lands late, sorts first
        lambda: put(f"{land}/b.parquet", [("x", 3.0)]),                                # replaced under its name
        lambda: put(f"{land}/deep/a.parquet", [("z", None), ("x", 10.0)]),           # written again, equal rows
        lambda: put(f"{land}/b.parquet", []),                                          # replaced by no rows
        lambda: os.remove(f"{land}/deep/a.parquet"),                                   # vanished
        lambda: put(f"{land}/c.parquet", [("w", 1.0)]),
        lambda: None,
    ]
    for i, step in enumerate(steps):
        step()
        assert answer(spark, land, name) == answer(spark, land, f"fresh-{uuid.uuid4().hex}"), i
    assert ops(spark, land, name) == [(1, "load", "b.parquet"), (2, "load", "a.parquet"), (3, "load", "b.parquet"), (4, "same", "a.parquet"),
                                      (5, "load", "b.parquet"), (6, "gone", "a.parquet"), (7, "load", "c.parquet")]


def test_many_files_and_a_repeated_batch(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(L, "FILES_PER_BATCH", 4)
    land, name = tmpdir_path + "/land", "many-" + uuid.uuid4().hex
    for i in range(10):
        put(f"{land}/f{i}.parquet", [("x", float(i)), (f"k{i}", 1.0)])
    real, calls = L.VersionedTable.replace_where, []

    def dies_after_commit(self, *args, **kwargs):
        out = real(self, *args, **kwargs)
        calls.append(out)
        if len(calls) == 2:
            raise RuntimeError("lost after the commit")
        return out
    monkeypatch.setattr(L.VersionedTable, "replace_where", dies_after_commit)
    with pytest.raises(Exception):
        totals(spark, land, name)
    got = dict((k, (n, t)) for k, n, t, _ in totals(spark, land, name))  # the second batch runs again
    assert got["x"] == (10, 45.0) and all(got[f"k{i}"] == (1, 1.0) for i in range(10)) and len(calls) >= 4


def events(rows):
    return pa.table({"event_id": pa.array(range(len(rows)), pa.int64()), "ts": pa.array([r[0] for r in rows], pa.timestamp("us")), "user_id": pa.array([1] * len(rows), pa.int64()),
                     "event_type": pa.array([r[1] for r in rows], pa.string()), "value": pa.array([r[2] for r in rows], pa.float64())})


@pytest.mark.parametrize("query, folder", [("q_stream_hourly", False), ("q_stream_hourly", True), ("q_stream_dedupe", False), ("q_stream_load_prices", False), ("q_stream_replaced_files", True)])
def test_registered_streams_follow_their_table(spark, tmpdir_path, query, folder):
    """The table is replaced between two runs under one state: the second gives a fresh run's rows."""
    fn, state = getattr(registry, query), uuid.uuid4().hex
    old = [(T0 + dt.timedelta(hours=i % 50), ("purchase", "view")[i % 2], float(i)) for i in range(400)]
    new = [(T0 + dt.timedelta(hours=30 + i % 20, days=10), ("view", "purchase")[i % 2], float(-i)) for i in range(100)]
    path = f"{tmpdir_path}/events.parquet"
    answers = []
    for rows in (old, new):
        if folder:
            spark.createDataFrame(events(rows).to_pandas()).withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.mode("overwrite").parquet(path)
        else:
            pq.write_table(events(rows), path)
        answers.append(sorted(map(str, fn(spark, tmpdir_path, state).collect())))
    assert answers[0] != answers[1] == sorted(map(str, fn(spark, tmpdir_path, None).collect())) != []


def test_log_is_not_written_by_a_task_that_runs_every_join(spark, tmpdir_path, monkeypatch):
    land, name = tmpdir_path + "/land", "plan-" + uuid.uuid4().hex
    put(f"{land}/a.parquet", [("x", 1.0)])
    ledger, plans = L.Ledger(spark, land, name), []
    real = DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        if path == ledger.log:
            plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return real(self, path, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    assert ledger.look() == 1
    # "Repartition n, false" is a coalesce: all partitions of the join, one after the other, in its task
    assert len(plans) == 1 and not re.search(r"Repartition \d+, false", plans[0]) and "RepartitionByExpression" in plans[0]


def test_a_large_file_is_not_stored_by_one_task(spark, tmpdir_path):
    land, name = tmpdir_path + "/land", "large-" + uuid.uuid4().hex
    put(f"{land}/a.parquet", [(f"k{i}", float(i)) for i in range(2000)])
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        assert len(totals(spark, land, name)) == 2000
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    table = L.VersionedTable(spark, f"{L.Ledger(spark, land, name).base}/rows", T.StructType([T.StructField(L.FILE, T.StringType())]), L.FILE)
    rows = sorted(r["rows"] for r in table.manifest().collect())
    assert len(rows) == 4 and sum(rows) == 2000 and rows[-1] < 1000
