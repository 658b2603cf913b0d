"""Hot keys: a star's centre, one giant near-copy group and one text in a third of the rows do not meet in a task."""
import pytest
from pyspark.sql import functions as F

from wattgrid.llm import simhash_dedup as S
from wattgrid.llm.common import components, join_summary, written


@pytest.fixture()
def no_broadcasts(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def most_in_a_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("key", ["0L", "CASE WHEN id % 3 = 0 THEN 0L ELSE id END", "id % 7", "id"])
def test_join_summary_spreads_hot_keys(spark, no_broadcasts, key):
    rows = written(spark.range(0, 60_000, 1, 16).select(F.expr(key).alias("k"), F.col("id").alias("x")), "rows")
    summary = rows.groupBy("k").agg(F.min("x").alias("low"), F.count(F.lit(1)).alias("_m"))
    joined = join_summary(rows, "k", summary, 60_000)
    assert joined.columns == ["k", "x", "low"]
    want = rows.groupBy("k").agg(F.min("x").alias("want"))
    assert joined.count() == 60_000 and joined.join(want, "k").filter("low <> want").count() == 0
    assert most_in_a_task(joined) <= 60_000 / 4  # as the scan of the rows deals them


def test_star(spark, no_broadcasts):
    """All edges at one centre, and a second star linked to it at the rims."""
    edges = spark.range(1, 20_001, 1, 16).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    edges = edges.union(spark.range(20_001, 30_000).select(F.lit(30_000).cast("long").alias("a"), F.col("id").alias("b"))).union(spark.sql("SELECT 20000L, 20001L"))
    got = components(edges)
    assert got.count() == 30_001 and got.filter("root <> 0").count() == 0


def test_one_giant_group(spark, no_broadcasts):
    """A third of the rows has one text, another third a near copy of it."""
    base = " ".join(f"word{i}" for i in range(400))
    texts = F.when(F.col("id") % 3 == 0, F.lit(base)).when(F.col("id") % 3 == 1, F.lit(base + " more")).otherwise(F.concat(F.lit("other text number "), F.col("id"), F.lit(" with its own words "), F.xxhash64("id")))
    docs = spark.range(0, 6_000, 1, 16).select(F.col("id").alias("doc_id"), texts.alias("text"))
    r = S.near_duplicates(docs)
    assert r.count() == 6_000 and r.filter("_id % 3 < 2 AND _component <> 0").count() == 0
    assert most_in_a_task(r) < 2_000
    kept = S.stage(spark, docs, "")
    assert kept.filter("doc_id % 3 < 2").count() == 1
