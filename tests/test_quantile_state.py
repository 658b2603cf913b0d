"""Stored value counts: any range, any order of arrival, stated error."""
import datetime as dt
import random

import numpy as np
import pytest

from wattgrid.plans.quantile_state import QuantileState

PROBS = {"q25": 0.25, "median": 0.5, "q75": 0.75, "top": 1.0}
SCHEMA = "country string, timestamp timestamp_ntz, value double, n long"


def rows(seed, n=1500):
    rng = random.Random(seed)
    t0 = dt.datetime(2023, 11, 15)
    return [(rng.choice(["ES", "ES", "PT", None]), t0 + dt.timedelta(hours=rng.randrange(24 * 90)), rng.choice([rng.gauss(50, 40), float(rng.randint(-5, 5))]), 1) for _ in range(n)]


def want(data, start, end):
    out = {}
    for k in {r[0] for r in data}:
        v = [r[2] for r in data if r[0] == k and r[2] is not None and r[2] == r[2] and r[1] and (not start or str(r[1])[:10] >= start) and (not end or str(r[1])[:10] < end)]
        if v:
            out[k] = (len(v), *np.quantile(v, list(PROBS.values())))
    return out


@pytest.mark.parametrize("resolution", [None, 0.5])
def test_any_range_equals_the_values(spark, tmp_path, resolution):
    data = rows(1) + [("ES", None, 1.0, 1), ("ES", dt.datetime(2024, 1, 1), None, 1), ("PT", dt.datetime(2024, 1, 1), float("nan"), 1)]
    state = QuantileState(spark, f"{tmp_path}/s", ["country"], resolution=resolution)
    parts = [data[2::3], data[0::3], data[1::3]]
    for i, p in enumerate(parts):
        state.add(spark.createDataFrame(p, SCHEMA), f"b{i}")
    state.add(spark.createDataFrame(parts[1], SCHEMA), "b1")  # a job run twice
    for start, end in ((None, None), ("2023-12-01", "2024-01-01"), ("2023-12-31", "2024-01-02"), (None, "2023-11-20"), ("2024-02-01", None), ("2030-01-01", None)):
        got = {r["country"]: tuple(r)[1:] for r in state.quantiles(PROBS, start, end).collect()}
        exp = want(data, start, end)
        assert got.keys() == exp.keys()
        for k in exp:
            assert got[k][0] == exp[k][0]
            assert np.allclose(got[k][1:], exp[k][1:], rtol=0, atol=1e-9 if resolution is None else resolution / 2 + 1e-9)


def test_other_months_are_not_read(spark, tmp_path):
    state = QuantileState(spark, f"{tmp_path}/s", ["country"])
    state.add(spark.createDataFrame(rows(2), SCHEMA), "b")
    plan = state.counts("2023-12-01", "2023-12-15")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan and "24287" in plan


def test_empty_batch_and_bad_resolution(spark, tmp_path):
    state = QuantileState(spark, f"{tmp_path}/s", ["country"])
    state.add(spark.createDataFrame(rows(3, 5), SCHEMA), "a")
    state.add(spark.createDataFrame([], SCHEMA), "b")
    assert sum(r["n"] for r in state.quantiles(PROBS).collect()) == 5
    with pytest.raises(ValueError):
        QuantileState(spark, "x", ["country"], resolution=0)
