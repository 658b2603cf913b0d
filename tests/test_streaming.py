"""Z1 / Z2 streaming re-aims, run with availableNow on local files."""
import datetime as dt

from pyspark.sql import functions as F

from wattgrid.operators.dedupe import keep_first
from wattgrid.schemas import PRICES_DAY_AHEAD, WIDE_PRICES
from wattgrid.streaming import incremental as Z


def _wide(day, concept, base):
    return (day, concept, *[base + i for i in range(1, 25)], None)


def test_incremental_first_wins_across_batches(spark, tmpdir_path):
    from wattgrid.plans.registry import load_wide_prices
    d1, d2 = dt.date(2022, 6, 14), dt.date(2022, 6, 15)
    spark.createDataFrame([_wide(d1, "PRICE_SP", 1.0), _wide(d2, "PRICE_SP", 1.0)], WIDE_PRICES) \
        .write.parquet(tmpdir_path + "/landing/f1")
    spark.createDataFrame([_wide(d2, "PRICE_SP", 50.0), _wide(d2, "PRICE_PT", 7.0)], WIDE_PRICES) \
        .write.parquet(tmpdir_path + "/landing/f2")
    target = tmpdir_path + "/prices"
    for _ in range(2):  # a re-run over the same landing folder must not duplicate anything
        Z.incremental_first_wins(spark, tmpdir_path + "/landing/*/*.parquet", WIDE_PRICES, load_wide_prices,
                                 target, PRICES_DAY_AHEAD, ["timestamp", "country"], ["source", "price_eur_mwh"],
                                 checkpoint_name="z1-" + tmpdir_path.rsplit("-", 1)[-1],
                                 max_files_per_trigger=1)
    t = spark.read.parquet(target)
    assert t.count() == 24 * 3
    assert t.filter((F.col("country") == "ES") & (F.col("price_eur_mwh") > 40)).count() == 0


def test_hourly_window_aggregate(spark, tmpdir_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(minutes=20 * i), "a", float(i)) for i in range(30)]
    spark.createDataFrame(rows, "ts timestamp_ntz, k string, v double").write.parquet(tmpdir_path + "/ev")
    st = spark.readStream.schema("ts timestamp_ntz, k string, v double").parquet(tmpdir_path + "/ev")
    out = Z.run_to_table(spark, Z.hourly_window_aggregate(st, "ts", "k", "v", "2 hours"), name="t1-" + tmpdir_path.rsplit("-", 1)[-1]).orderBy("window_start")
    got = out.collect()
    # max event 09:40 -> watermark 07:40 -> windows ending by 07:00 are final
    assert [r["window_start"].hour for r in got] == list(range(7))
    assert all(r["n"] == 3 for r in got) and got[0]["total"] == 3.0


def test_dedupe_within_watermark(spark, tmpdir_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0, "a", 1.0), (t0, "a", 2.0), (t0 + dt.timedelta(hours=1), "a", 3.0)]
    spark.createDataFrame(rows, "ts timestamp_ntz, k string, v double").write.parquet(tmpdir_path + "/ev")
    st = spark.readStream.schema("ts timestamp_ntz, k string, v double").parquet(tmpdir_path + "/ev")
    out = Z.run_to_table(spark, Z.dedupe_within_watermark(st, "ts", ["ts", "k"], "1 hour"), name="t2-" + tmpdir_path.rsplit("-", 1)[-1])
    assert out.count() == 2
    assert keep_first(out, ["ts", "k"], ["v"]).count() == 2


def test_incremental_resume_after_new_file(spark, tmpdir_path):
    from wattgrid.plans.loading import load_wide_prices
    d1, d2 = dt.date(2022, 6, 14), dt.date(2022, 6, 15)
    ck = "z1-resume-" + tmpdir_path.rsplit("-", 1)[-1]
    target = tmpdir_path + "/prices"
    args = (tmpdir_path + "/landing/*/*.parquet", WIDE_PRICES, load_wide_prices, target, PRICES_DAY_AHEAD,
            ["timestamp", "country"], ["source", "price_eur_mwh"])
    spark.createDataFrame([_wide(d1, "PRICE_SP", 1.0)], WIDE_PRICES).write.parquet(tmpdir_path + "/landing/f1")
    Z.incremental_first_wins(spark, *args, checkpoint_name=ck)
    assert spark.read.parquet(target).count() == 24
    # a later file repeats day 1 with other prices and adds day 2
    spark.createDataFrame([_wide(d1, "PRICE_SP", 500.0), _wide(d2, "PRICE_SP", 2.0)], WIDE_PRICES) \
        .write.parquet(tmpdir_path + "/landing/f2")
    Z.incremental_first_wins(spark, *args, checkpoint_name=ck)
    t = spark.read.parquet(target)
    assert t.count() == 48
    assert t.filter(F.col("price_eur_mwh") > 400).count() == 0  # stored rows win over later arrivals


def test_late_event_beyond_watermark_is_dropped(spark, tmpdir_path):
    t0 = dt.datetime(2024, 1, 1)
    schema = "ts timestamp_ntz, k string, v double"
    name = "z2-late-" + tmpdir_path.rsplit("-", 1)[-1]
    spark.createDataFrame([(t0 + dt.timedelta(minutes=30 * i), "a", 1.0) for i in range(21)], schema) \
        .coalesce(1).write.parquet(tmpdir_path + "/ev/f1")          # events 00:00 .. 10:00
    first = lambda: Z.run_to_table(spark, Z.hourly_window_aggregate(
        spark.readStream.schema(schema).parquet(tmpdir_path + "/ev/*/*.parquet"), "ts", "k", "v", "2 hours"), name)
    out1 = {r["window_start"].hour: r["n"] for r in first().collect()}
    assert out1 == {h: 2 for h in range(8)}                        # watermark 08:00: windows up to 07:00 final
    # later file: one event at 02:15 (behind the watermark) and new events up to 14:00
    rows = [(t0 + dt.timedelta(hours=2, minutes=15), "a", 100.0)] + \
        [(t0 + dt.timedelta(hours=11 + i), "a", 1.0) for i in range(4)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(tmpdir_path + "/ev/f2")
    out2 = {r["window_start"].hour: (r["n"], r["total"]) for r in first().collect()}
    assert out2[2] == (2, 2.0)                                     # the late row did not reopen 02:00
    assert out2[8] == (2, 2.0) and out2[10] == (1, 1.0)            # windows closed by the new watermark


def _three_files_late_first(spark, base):
    """Three files of ten events each, landed in reverse time order, with repeats."""
    t0 = dt.datetime(2024, 1, 1)
    schema = "ts timestamp_ntz, k string, v double"
    rows = [[(t0 + dt.timedelta(hours=10 * f, minutes=45 * (i // 2)), "a", float(i)) for i in range(10)] for f in range(3)]
    for landed, part in enumerate(reversed(rows)):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{base}/ev/f{landed}")
    return schema, [r for part in rows for r in part]


def test_exact_totals_do_not_depend_on_batches(spark, tmpdir_path):
    from wattgrid.functions import timecols as tc
    schema, rows = _three_files_late_first(spark, tmpdir_path)
    want = {}
    for t, k, v in rows:
        n, total = want.get(t.replace(minute=0), (0, 0.0))
        want[t.replace(minute=0)] = n + 1, total + v
    for per_batch in (1, 64):
        st = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(tmpdir_path + "/ev/*")
        st = st.select(tc.trunc_hour("ts").alias("h"), "k", "v")
        for _ in range(2):  # started again under its name, it finds nothing new and says the same
            out = Z.incremental_totals(spark, st, ["h", "k"], "v", f"totals-{per_batch}-" + tmpdir_path.rsplit("-", 1)[-1])
            assert {r["h"]: (r["n"], r["total"]) for r in out.collect()} == want
            assert sum(r["n"] for r in out.collect()) == len(rows)


def test_first_wins_keeps_every_key_in_any_order(spark, tmpdir_path):
    schema, rows = _three_files_late_first(spark, tmpdir_path)
    target = tmpdir_path + "/keys"
    keys = spark.createDataFrame([], "ts timestamp_ntz, k string").schema
    Z.incremental_first_wins(spark, tmpdir_path + "/ev/*/*.parquet", spark.createDataFrame([], schema).schema, lambda b: b.select("ts", "k"), target, keys,
                             ["ts", "k"], [], checkpoint_name="keys-" + tmpdir_path.rsplit("-", 1)[-1], max_files_per_trigger=1, range_col="ts")
    got = [(r["ts"], r["k"]) for r in spark.read.parquet(target).collect()]
    assert sorted(got) == sorted({(t, k) for t, k, _ in rows})


def test_resume_after_a_failed_batch(spark, tmpdir_path):
    """A load that dies in its second batch goes on from there; nothing is lost or doubled."""
    import pytest
    schema, rows = _three_files_late_first(spark, tmpdir_path)
    target = tmpdir_path + "/keys"
    keys = spark.createDataFrame([], "ts timestamp_ntz, k string").schema
    calls = []

    def transform(b):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return b.select("ts", "k")
    args = (spark, tmpdir_path + "/ev/*/*.parquet", spark.createDataFrame([], schema).schema, transform, target, keys, ["ts", "k"], [])
    kw = {"checkpoint_name": "resume-" + tmpdir_path.rsplit("-", 1)[-1], "max_files_per_trigger": 1, "range_col": "ts"}
    with pytest.raises(Exception, match="lost"):
        Z.incremental_first_wins(*args, **kw)
    assert 0 < spark.read.parquet(target).count() < len({(t, k) for t, k, _ in rows})
    Z.incremental_first_wins(*args, **kw)
    assert sorted((r["ts"], r["k"]) for r in spark.read.parquet(target).collect()) == sorted({(t, k) for t, k, _ in rows})
    assert len(calls) == 4  # the first batch was not run again


def test_only_a_missing_table_counts_as_empty(spark, tmpdir_path):
    import pytest
    schema = spark.createDataFrame([], "a int").schema
    assert Z.stored_table(spark, tmpdir_path + "/none", schema).count() == 0
    with open(tmpdir_path + "/bad.parquet", "wb") as fh:
        fh.write(b"not parquet at all")
    with pytest.raises(Exception):
        Z.stored_table(spark, tmpdir_path + "/bad.parquet", schema).count()
