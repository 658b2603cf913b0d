"""The reference workflow on files: land -> load (first wins) -> panel -> store -> analyse."""
import os

import pytest
from pyspark.sql import functions as F

from wattgrid.operators import panel as P
from wattgrid.plans import analytics as X
from wattgrid.plans import standins as SI
from wattgrid.plans.loading import load_wide_prices
from wattgrid.schemas import PRICES_DAY_AHEAD, WIDE_PRICES, conform
from wattgrid.sources import files, sinks

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_land_load_panel_store_analyse(spark, tmpdir_path):
    landing = tmpdir_path + "/raw"
    wide = SI.wide_prices(spark, SF)
    # two landing files, named as acquisition chunks; the second overlaps the first
    for part, name in (("part_a", "day_ahead_prices_2024-01-01_2024-01-20"),
                       ("part_b", "day_ahead_prices_2024-01-15_2024-01-30")):
        conform(wide.filter(F.col("source") == part), WIDE_PRICES).coalesce(1).write.parquet(f"{landing}/{name}")
    raw = files.read_wide_prices(spark, f"{landing}/day_ahead_prices_*")
    assert raw.select("source").distinct().count() == 2
    table = tmpdir_path + "/prices_day_ahead"
    sinks.append_ignore(spark, load_wide_prices(raw), table, PRICES_DAY_AHEAD, ["timestamp", "country"],
                        ["source", "price_eur_mwh"])
    sinks.append_ignore(spark, load_wide_prices(raw), table, PRICES_DAY_AHEAD, ["timestamp", "country"],
                        ["source", "price_eur_mwh"])  # re-running the load adds nothing
    prices = spark.read.parquet(table)
    assert prices.groupBy("timestamp", "country").count().filter("count > 1").count() == 0
    expected = load_wide_prices(wide).count()  # same rows as the in-memory stand-in load
    assert prices.count() == expected
    # overlap days come from the earlier file (its prices are not the +1 copies)
    mine = prices.join(load_wide_prices(wide).select("timestamp", "country", F.col("price_eur_mwh").alias("ref")),
                       ["timestamp", "country"])
    assert mine.filter(F.col("price_eur_mwh") != F.col("ref")).count() == 0

    panel = P.build_main_panel(spark, prices, "2024-01-01", "2024-01-30", ["ES", "PT"], policy=SI.POLICY)
    assert panel.count() == 30 * 24 * 2
    sinks.write_panel(panel, tmpdir_path + "/panel")
    stored = files.read_panel(spark, tmpdir_path + "/panel", "2024-01-01", "2024-02-01")
    assert stored.count() == panel.count()
    impact = {r["country"]: r for r in X.policy_impact(stored).collect()}
    assert set(impact) == {"ES", "PT"} and impact["ES"]["rows_during"] == 10 * 24
    coupling = X.coupling(stored, "ES", "PT").collect()[0]
    assert coupling["n_hours"] == 30 * 24
