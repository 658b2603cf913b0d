"""NULL keys, unlisted values and value scales: nothing is lost, nothing meets in one task."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattgrid.functions.keys import join_on_keys
from wattgrid.operators import dedupe as D
from wattgrid.operators import joins as J
from wattgrid.operators import reshape as R
from wattgrid.operators import series as S
from wattgrid.operators import stats as A
from wattgrid.plans import analytics as X


def values(kind):
    rng = random.Random(len(kind))
    return {"unit": [rng.random() for _ in range(400)], "wide": [10 ** rng.uniform(-9, 9) for _ in range(400)],
            "signed": [rng.choice([-1, 1]) * 2.0 ** rng.randint(-5, 5) for _ in range(300)] + [0.0] * 20,
            "third": [rng.uniform(-5, 5) for _ in range(200)] + [1.25] * 100}[kind]


@pytest.mark.parametrize("kind", ["unit", "wide", "signed", "third"])
def test_ranks_and_quantiles_at_every_scale(spark, kind):
    vs = values(kind)
    rows = [(k, v) for k in ("a", None) for v in vs] + [("a", None), ("only null", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    steps = {(r["k"], r["v"]): r for r in S.duration_steps(df, ["k"], "v").collect()}
    for v in set(vs):
        assert steps[None, v]["rank_first"] == sum(x > v for x in vs) == steps["a", v]["rank_first"]
    assert steps["a", None]["rank_first"] == len(vs) and steps["a", None]["n_total"] == len(vs) + 1
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["k"]: r for r in A.quantiles(df, ["k"], "v", probs, [f"q{i}" for i in range(6)]).collect()}
    assert set(got) == {"a", None}
    for i, q in enumerate(np.quantile(vs, probs)):
        assert math.isclose(got["a"][f"q{i}"], q, rel_tol=1e-12, abs_tol=1e-15) and got[None][f"q{i}"] == got["a"][f"q{i}"]


def test_bands_follow_order(spark):
    vs = sorted({x for k in ("unit", "wide", "signed", "third") for x in values(k)} | {2.0 ** e for e in range(-60, 60)} | {-1e308, 1e308, 5e-324, -5e-324, 1e-300, float("inf"), float("-inf")})
    bands = {r["v"]: r["b"] for r in spark.createDataFrame([(v,) for v in vs], "v double").select("v", S.value_band(F.col("v")).alias("b")).collect()}
    in_order = [bands[v] for v in vs]
    assert in_order == sorted(in_order) and len(set(in_order)) > 0.7 * len(vs)


def test_null_groups_stay(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0), ("a", 5.0)], "k string, v double")
    assert {r["k"] for r in A.histogram(df, ["k"], "v", bins=2).collect()} == {None, "a"}
    assert {(r["k"], r["median"]) for r in A.box_stats(df, ["k"], "v").collect()} == {(None, 1.5), ("a", 4.0)}
    assert {(r["k"], r["median"]) for r in A.group_stats(df, ["k"], "v").collect()} == {(None, 1.5), ("a", 4.0)}
    assert sum(r["share"] for r in X.shares(df.withColumn("p", F.lit("x")), ["k"], "p", "v").collect()) == 2.0
    bids = spark.createDataFrame([(None, "s", 1.0, 5.0), (None, "s", None, 2.0), ("d", "s", 1.0, 0.0), ("d", "s", 1.0, None)], "day string, bid_type string, price_eur_mwh double, quantity_mw double")
    cum = {(r["day"], r["price_eur_mwh"]): r["cum_quantity"] for r in X.supply_curve(bids, ["day", "bid_type"]).collect()}
    assert cum == {(None, 1.0): 5.0, (None, None): 7.0, ("d", 1.0): 0.0}


def test_null_keys_match(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert D.duplicated_rows(df, ["k"]).count() == 2
    assert [r["k"] for r in D.insert_or_ignore(df, spark.createDataFrame([(None, 9)], "k string, v int"), ["k"], ["v"]).collect()] == ["a"]
    assert [r["k"] for r in J.unmatched(df, spark.createDataFrame([(None,)], "k string"), ["k"]).collect()] == ["a"]
    with pytest.raises(ValueError):
        join_on_keys(df, df, [])


def test_parts_of_one_table(spark):
    df = spark.createDataFrame([("x", 1, 1.0), ("y", 1, 1.0), ("x", 2, None), ("y", 2, None), ("x", 3, 1.0), ("y", None, 2.0), ("x", None, 2.0), ("z", 9, 1.0)], "s string, k int, v double")
    left, right = F.col("s") == "x", F.col("s") == "y"
    a = J.key_alignment(df, ["k"], left, right).first()
    assert (a["matched"], a["only_left"], a["only_right"], a["aligned"]) == (3, 1, 0, False)
    e = J.series_equal(df, ["k"], "v", left, right).first()
    assert (e["n"], e["equal"], e["n_different"]) == (4, False, 1)


def test_unlisted_values_have_a_column(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "q", 2.0), (1, None, 4.0), (None, "b", 8.0)], "i int, p string, v double")
    rows = {r["i"]: r for r in R.long_to_wide(df, ["i"], ["p"], ["a", "b"], "v", "sum", other="other").collect()}
    assert (rows[1]["a"], rows[1]["other"], rows[None]["b"], rows[None]["other"]) == (1.0, 6.0, 8.0, None)
    two = R.long_to_wide(df.withColumn("w", F.col("p")), ["i"], ["p", "w"], [("a", "a")], "v", "sum", "{0}_{1}", "other")
    assert sum(r["other"] or 0 for r in two.collect()) == 14.0


def test_no_order_statistics_in_one_task(spark):
    """Exact quantiles come from ranks: no aggregate that holds a whole group's values."""
    df = spark.createDataFrame([("a", 1.0, True)], "country string, price_eur_mwh double, in_policy boolean").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("phase", F.lit("x"))
    for out in (X.policy_impact(df), X.phase_stats(df), A.group_stats(df, ["country"], "price_eur_mwh"), A.box_stats(df, ["country"], "price_eur_mwh"),
                R.describe_side_by_side(df, "country", "price_eur_mwh", ["a"])):
        assert "percentile" not in out._jdf.queryExecution().toString().lower()
