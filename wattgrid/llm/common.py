"""What the operators share: written intermediates, row identities, graph components."""
from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder in the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/wattgrid-llm/{label}-{uuid.uuid4().hex}"


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application, so that the
    operators run wherever the driver's own import path ends."""
    sc = spark.sparkContext
    if getattr(sc, "_wattgrid_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="wattgrid-"), "wattgrid.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("wattgrid", os.path.relpath(full, top)))
    sc.addPyFile(path)
    sc._wattgrid_shipped = True


_HELD: dict = {}


def held(key: tuple, make):
    """The worker process's one large object (an encoder, a model and what it remembers). Worker
    processes serve many operators in turn; another key lets the object before it go."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, a lost
    executor costs no recomputation, and row numbers stored in it stay as they are."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def masked(df: DataFrame) -> DataFrame:
    """``df`` with its columns named by place (``c0``, ``c1``, ...): an operator's own columns
    cannot clash with the input's, whatever those are called."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place_of(df: DataFrame, name: str) -> str:
    """The name that ``masked`` gives to the column called exactly ``name``."""
    return f"c{df.columns.index(name)}"


def text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``_x``, ``_n`` and ``_text`` (NULL text: empty) of every row, nothing else.

    ``_id``, ``_x`` (hash of the text) and ``_n`` (its bytes) identify a row by its
    content: rows that share them are repeats of each other and interchangeable.
    Only the two named columns are read, so extra columns may have any names.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(place_of(docs, text_col)), F.lit(""))
    return masked(docs).select(F.col(place_of(docs, id_col)).alias("_id"), F.xxhash64(text).alias("_x"),
                               F.octet_length(text).alias("_n"), text.alias("_text"))


IDENTITY = ["_id", "_x", "_n"]


def same(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    """Null-safe equality of the named columns of two frames."""
    on = a[cols[0]].eqNullSafe(b[cols[0]])
    for c in cols[1:]:
        on = on & a[c].eqNullSafe(b[c])
    return on


def keep_rows(docs: DataFrame, decisions: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` (all columns) that ``decisions`` keeps.

    ``decisions`` is a written table with the identity columns and ``_kept``, one row
    per row of ``docs``. The rows to drop are the smaller side, so they are what is
    joined; Spark broadcasts them only below its measured size limit. Of repeats of
    one row that are not all kept, one stays.
    """
    per = decisions.groupBy(*IDENTITY).agg(F.sum(F.col("_kept").cast("long")).alias("_k"),
                                           F.count(F.lit(1)).alias("_m"))
    gone = per.filter("_k = 0").select(*[F.col(c).alias(f"_gone{c}") for c in IDENTITY])
    names, rows = docs.columns, masked(docs)
    text = F.coalesce(F.col(place_of(docs, text_col)), F.lit(""))
    rows = rows.select("*", F.col(place_of(docs, id_col)).alias("_id"), F.xxhash64(text).alias("_x"), F.octet_length(text).alias("_n"))

    def on(other: DataFrame, prefix: str) -> Column:
        cond = rows["_id"].eqNullSafe(other[f"{prefix}_id"])
        return cond & (rows["_x"] == other[f"{prefix}_x"]) & (rows["_n"] == other[f"{prefix}_n"])

    out = rows.join(gone, on(gone, "_gone"), "left_anti")
    some = per.filter("_k > 0 AND _k < _m").select(*[F.col(c).alias(f"_some{c}") for c in IDENTITY])
    if not some.isEmpty():
        # every row of an identity says the same, so one of them stands for those kept
        once = out.join(some, on(some, "_some"), "left_semi").dropDuplicates(IDENTITY)
        out = out.join(some, on(some, "_some"), "left_anti").unionByName(once)
    return out.drop(*IDENTITY).toDF(*names)


HUBS = 5000


def join_summary(rows: DataFrame, key: str, summary: DataFrame, n: int) -> DataFrame:
    """Inner join of ``rows`` (written, ``n`` at most) with ``summary``: one row per key, with ``_m``, how many
    rows hold it (or more). Hot keys do not meet in one task: those with over an ``n / HUBS`` share of the rows are fewer
    than ``HUBS`` (the ``_m`` add up to ``n``), so their part of the summary is broadcast; all others are
    shuffled, and none of these fills a task."""
    limit = max(1000, n // HUBS)
    names = [c for c in summary.columns if c not in (key, "_m")]
    keyed = summary.withColumnRenamed(key, "_k")
    marked = rows.join(F.broadcast(keyed.filter(F.col("_m") > limit).drop("_m").withColumn("_hub", F.lit(True))), rows[key] == F.col("_k"), "left").drop("_k")
    hot = marked.filter("_hub").drop("_hub")
    cold = marked.filter("_hub IS NULL").drop("_hub", *names)
    cold = cold.join(keyed.filter(F.col("_m") <= limit).drop("_m"), cold[key] == F.col("_k")).drop("_k")
    return hot.select(*rows.columns, *names).union(cold.select(*rows.columns, *names))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges(a, b)``: ``node``, ``root`` (the smallest node).

    Large-star and small-star steps in turn: each points nodes at the smallest
    neighbour they know, so the work per round follows the number of edges. A star's centre, which most edges may
    hold, is joined by ``join_summary``, so no component ever meets in one task. Every step is written to the shared folder.
    Empty input gives an empty result; loops and repeated edges do no harm.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = written(e.filter("u <> v").distinct(), label)
    n, before = e.count(), None
    while True:
        # large star: every larger neighbour of a node points at the smallest one
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"), "_m")
        # e holds u > v, so the larger neighbours u of a centre v are its rows
        large = (join_summary(e, "v", low, 2 * n).select("u", F.col("m").alias("v")).filter("u <> v")
                 .union(low.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        large = written(large, label)
        # small star: smaller neighbours and the node itself point at the smallest
        low2 = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_m"))
        small = (join_summary(large, "u", low2, 3 * n).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").union(low2.select("u", F.col("m").alias("v"))).distinct())
        e = written(small, label)
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before, n = mark, mark[0]
    roots = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
