"""Scale-critical plan shapes: no window over a whole series, map-side combine before shuffles."""
import datetime as dt
import re

from pyspark.sql import functions as F

from wattgrid.operators import dedupe as D
from wattgrid.operators import series as S
from wattgrid.plans import analytics as X

T0 = dt.datetime(2024, 1, 1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _series(spark, n=500):
    # one hot key with most rows, as in a skewed production table
    rows = [(T0 + dt.timedelta(hours=i), "hot" if i % 3 else "cold", float(i % 17)) for i in range(n)]
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, k string, v double")


def test_rolling_and_changes_partition_by_key_and_bucket(spark):
    df = _series(spark)
    for out, bucket in ((S.rolling_stats(df, ["k"], "timestamp", "v"), "_b"),
                        (S.changes(df, ["k"], "timestamp", "v"), "_bk")):
        plan = _plan(out)
        specs = re.findall(r"windowspecdefinition\(k#\d+, " + bucket, plan)
        assert specs, plan
        # every window over the rows is keyed by the bucket too; only the per-bucket summary
        # (one row per bucket) is ordered by the bucket within a key
        for m in re.findall(r"windowspecdefinition\(k#\d+, ([^,]+)", plan):
            assert m.startswith(bucket), m


def test_duration_value_window_is_banded(spark):
    plan = _plan(S.duration_steps(_series(spark), ["k"], "v"))
    assert re.search(r"windowspecdefinition\(k#\d+, _band#\d+", plan)


def test_keep_first_combines_map_side(spark):
    df = _series(spark).withColumn("src", F.lit("a"))
    plan = _plan(D.keep_first(df, ["k"], ["src", "v"]))
    assert "partial_min_by" in plan
    assert plan.index("partial_min_by") > plan.index("Exchange")  # partial agg sits below the exchange


def test_supply_curve_levels_combine_before_shuffle(spark):
    bids = _series(spark).select(F.lit("XX").alias("country"), F.to_date("timestamp").alias("timestamp"),
                                 F.col("v").alias("price_eur_mwh"), F.lit(1.0).alias("quantity_mw"))
    plan = _plan(X.supply_curve(bids, ["timestamp", "country"]))
    assert "partial_sum" in plan
    assert "windowspecdefinition(timestamp" in plan and "_band" in plan


def test_no_registered_query_windows_over_everything(spark):
    """No window without a key over rows of data: one task would see them all."""
    from wattgrid.plans import registry
    for name, fn in registry.queries().items():
        if name.startswith(("stream_", "load_files", "file_inventory")):
            continue  # they write tables; their plans are covered by their operators
        plan = fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        for spec in re.findall(r"windowspecdefinition\(([^)]*)", plan):
            first = spec.split(",")[0]
            if first.startswith("_y#"):
                continue  # one row per year: the carry of a table without keys
            assert "ASC" not in first and "DESC" not in first and "specifiedwindowframe" not in first, (name, spec)
        assert "Cartesian" not in fn(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString(), name
