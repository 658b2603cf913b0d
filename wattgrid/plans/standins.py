"""Stand-in sources built by Spark from the driver's tables.

The driver's data holds no prices, weather or flows, so the operators are run on
series derived from it. Each builder reads whole tables; nothing is sampled.

| role                       | derived from                                            |
|----------------------------|---------------------------------------------------------|
| hourly price per "country" | ``events``: hour of ``ts`` x ``event_type``, avg(value)  |
| city weather               | ``events``: hour x location ``L{user_id % 7}``           |
| wide price file (2 files)  | the hourly series pivoted by hour, split into 2 overlapping parts |
| cross-border flows         | ``lineitem`` x ``orders`` x customer / supplier region, by month |
| bid curves                 | ``lineitem``: unit price, quantity per ship day          |
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timecols as tc
from ..functions.numeric import nan_to_null
from ..operators import panel as P
from ..operators import reshape as R
from ..operators import stats as A
from ..operators import timeaxis as tx

# Fixed values for the stand-ins.
POLICY = ("2024-01-10", "2024-01-19")
PAIR = ("purchase", "view")
CITY_TO_SERIES = {"L0": "purchase", "L1": "purchase", "L2": "purchase", "L3": "purchase",
                  "L4": "view", "L5": "view", "L6": "view"}
CITY_WEIGHTS = {"L0": 4.0, "L1": 3.0, "L2": 2.0, "L3": 1.0, "L4": 3.0, "L5": 2.0, "L6": 1.0}
SERIES_TO_CONCEPT = {"purchase": "PRICE_SP", "view": "PRICE_PT"}
CONCEPTS = ["PRICE_SP", "PRICE_PT"]
DELAY_HOURS = 6
FILE_A_LAST_DAY = 20
FILE_B_FIRST_DAY = 15
REGION_KEYS = [0, 1, 2, 3, 4]
FLOW_PAIRS = [(a, b) for a in REGION_KEYS for b in REGION_KEYS]
TECHNOLOGIES = ["A", "N", "R"]
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hourly_prices(spark: SparkSession, sf_dir: str, where=None) -> DataFrame:
    """(timestamp, country, price_eur_mwh, energy_mwh): unique per key by construction.

    ``where`` filters the raw events (so it reaches the Parquet scan); a time
    range on hour boundaries selects exactly the same hours as filtering the
    hourly result.
    """
    e = table(spark, sf_dir, "events").filter(F.col("ts").isNotNull() & F.col("event_type").isNotNull())
    if where is not None:
        e = e.filter(where)
    v = nan_to_null("value")
    return e.groupBy(tc.trunc_hour("ts").alias("timestamp"), F.col("event_type").alias("country")) \
        .agg(F.avg(v).alias("price_eur_mwh"), F.sum(v).alias("energy_mwh"))


def city_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(timestamp, location, temperature_c, wind_speed_100m) per hour and location."""
    e = table(spark, sf_dir, "events").filter(F.col("ts").isNotNull() & F.col("user_id").isNotNull())
    loc = F.concat(F.lit("L"), (F.col("user_id") % 7).cast("string"))
    return e.groupBy(tc.trunc_hour("ts").alias("timestamp"), loc.alias("location")).agg(
        F.avg(nan_to_null("value")).alias("temperature_c"),
        F.avg((F.col("user_id") % 50).cast("double")).alias("wind_speed_100m"))


def country_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = P.dimension(spark, CITY_TO_SERIES, "location", "country")
    return P.weather_by_country(city_weather(spark, sf_dir), dim, ["temperature_c", "wind_speed_100m"])


def country_weather_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12 option: population-style weights per city instead of a plain mean."""
    rows = [(k, v, CITY_WEIGHTS[k]) for k, v in CITY_TO_SERIES.items()]
    dim = spark.createDataFrame(rows, "location string, country string, weight double")
    return P.weather_by_country(city_weather(spark, sf_dir), dim, ["temperature_c", "wind_speed_100m"],
                                weight_col="weight")


def city_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(timestamp, location, direction): the events' directions (``user_id`` as degrees) per hour and location."""
    e = table(spark, sf_dir, "events").filter(F.col("ts").isNotNull() & F.col("user_id").isNotNull())
    rows = e.select(tc.trunc_hour("ts").alias("timestamp"), F.concat(F.lit("L"), (F.col("user_id") % 7).cast("string")).alias("location"),
                    (F.col("user_id") % 360).alias("wind_direction_100m"))
    return A.circular_by_group(rows, ["timestamp", "location"], "wind_direction_100m")


def country_directions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: (timestamp, country, direction, steadiness, n) over its cities, by their weights."""
    rows = [(k, v, CITY_WEIGHTS[k]) for k, v in CITY_TO_SERIES.items()]
    dim = spark.createDataFrame(rows, "location string, country string, weight double")
    cities = city_directions(spark, sf_dir).select("timestamp", "location", "direction").join(dim, "location")
    return A.circular_by_group(cities, ["timestamp", "country"], "direction", "weight")


def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gapless hour x series spine over the data's whole day range, bounds from the raw rows."""
    e = table(spark, sf_dir, "events").filter(F.col("ts").isNotNull() & F.col("event_type").isNotNull())
    raw = e.select(F.col("ts").alias("timestamp"), F.col("event_type").alias("country"))
    return tx.keyed_hour_spine(tx.shared_day_bounds(raw, ["country"]), ["country"], "first_day", "last_day")


def panel(spark: SparkSession, sf_dir: str, with_weather: bool = True) -> DataFrame:
    hourly = hourly_prices(spark, sf_dir)
    weather = country_weather(spark, sf_dir) if with_weather else None
    return P.build_panel(spine(spark, sf_dir), hourly, weather, policy=POLICY)


def wide_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping 'files' of wide prices: DATE, CONCEPT, H1..H24, source.

    part_a holds days 1..20 of each month, part_b days 15.. with every price
    +1, so the overlap disagrees and first-wins by file name is observable.
    """
    h = hourly_prices(spark, sf_dir)
    concept = F.coalesce(F.create_map(*[x for k, v in SERIES_TO_CONCEPT.items() for x in (F.lit(k), F.lit(v))])
                         [F.col("country")], F.upper("country"))
    h = h.select(F.to_date("timestamp").alias("DATE"), concept.alias("CONCEPT"),
                 F.hour("timestamp").alias("_hour"), "price_eur_mwh")
    wide = R.long_to_wide(h, ["DATE", "CONCEPT"], ["_hour"], list(range(24)), "price_eur_mwh", "max",
                          name_fmt="H{0}")
    wide = wide.select("DATE", "CONCEPT", *[F.col(f"H{i}").alias(f"H{i + 1}") for i in range(24)])
    a = wide.filter(F.dayofmonth("DATE") <= FILE_A_LAST_DAY).withColumn("source", F.lit("part_a"))
    b = wide.filter(F.dayofmonth("DATE") >= FILE_B_FIRST_DAY).select(
        "DATE", "CONCEPT", *[(F.col(f"H{i}") + 1.0).alias(f"H{i}") for i in range(1, 25)]) \
        .withColumn("source", F.lit("part_b"))
    return a.unionByName(b)


def flows_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(timestamp = month start, country_from, country_to, flow_mw).

    Customer region -> supplier region, sum of ``l_quantity`` per order month.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    nc = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("_from"))
    ns = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("_to"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(nc, "c_nationkey").join(ns, "s_nationkey"))
    return j.groupBy(tc.trunc_month("o_orderdate").alias("timestamp"),
                     F.concat(F.lit("R"), F.col("_from").cast("string")).alias("country_from"),
                     F.concat(F.lit("R"), F.col("_to").cast("string")).alias("country_to")) \
        .agg(F.sum("l_quantity").alias("flow_mw"))


def flows_wide(flows: DataFrame) -> DataFrame:
    """One column per directed pair, ``R{a}_to_R{b}_mw``."""
    pairs = [(f"R{a}", f"R{b}") for a, b in FLOW_PAIRS]
    return R.long_to_wide(flows, ["timestamp"], ["country_from", "country_to"], pairs, "flow_mw", "sum",
                          name_fmt="{0}_to_{1}_mw", other="other_mw")


HOURLY_FLOW_PAIRS = [(f"U{a}", f"V{b}") for a in range(2) for b in range(3)]


def hourly_flows_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly flows from the events (user group to user group, summed value), one column a pair."""
    e = table(spark, sf_dir, "events").filter(F.col("ts").isNotNull())
    fl = e.select(tc.trunc_hour("ts").alias("timestamp"), F.concat(F.lit("U"), (F.col("user_id") % 2).cast("string")).alias("country_from"),
                  F.concat(F.lit("V"), (F.col("user_id") % 3).cast("string")).alias("country_to"), nan_to_null("value").alias("flow_mw"))
    return R.long_to_wide(fl, ["timestamp"], ["country_from", "country_to"], HOURLY_FLOW_PAIRS, "flow_mw", "sum", name_fmt="{0}_to_{1}_mw", other="other_mw")


def land_wide_files(spark: SparkSession, sf_dir: str, base: str) -> list[str]:
    """Write the two wide 'files' as they come from different tools: one with a timestamp
    ``DATE`` and no ``H25``, one with text dates. Returns their folders."""
    wide = wide_prices(spark, sf_dir)
    a = wide.filter(F.col("source") == "part_a").drop("source").withColumn("DATE", F.col("DATE").cast("timestamp_ntz"))
    b = wide.filter(F.col("source") == "part_b").drop("source").withColumn("DATE", F.date_format("DATE", "dd/MM/yyyy")).withColumn("H25", F.lit(None).cast("double"))
    paths = [f"{base}/part_a", f"{base}/part_b"]
    for df, path in zip((a, b), paths):
        df.write.mode("overwrite").parquet(path)
    return paths


AUTUMN_DAYS, SPRING_DAYS = 290, 70  # moves January's series over the clock changes of the same year
SHIFT_FROM = "2024-01-15"


def local_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country, feed, line, stamp): the hourly series as market files give it, plain local text in the order
    of delivery. ``autumn`` and ``spring`` are true local time over a clock change; ``naive`` writes every wall hour of the spring days."""
    h = hourly_prices(spark, sf_dir).filter(F.col("price_eur_mwh").isNotNull())
    feeds = F.explode(F.array(*[F.struct(F.lit(n).alias("feed"), F.lit(d).alias("days"), F.lit(z).alias("zoned"))
                                for n, d, z in (("autumn", AUTUMN_DAYS, True), ("spring", SPRING_DAYS, True), ("naive", SPRING_DAYS, False))])).alias("f")
    h = h.select("country", "timestamp", feeds).withColumn("_utc", F.timestamp_add("DAY", F.col("f.days"), F.col("timestamp")))
    wall = F.when(F.col("f.zoned"), F.convert_timezone(F.lit("UTC"), F.lit("Europe/Madrid"), F.col("_utc"))).otherwise(F.col("_utc"))
    return h.select("country", F.col("f.feed").alias("feed"), tc.hour_number("timestamp").alias("line"), F.date_format(wall, "yyyy-MM-dd HH:mm").alias("stamp"))


def shifted_keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two key sets: hours priced above 50, and the same with stamps an hour late from ``SHIFT_FROM`` on."""
    h = hourly_prices(spark, sf_dir).filter(F.col("price_eur_mwh") > 50).select("country", "timestamp")
    late = F.when(F.col("timestamp") >= tc.ntz(SHIFT_FROM), 1).otherwise(0)
    return h, h.select("country", tc.add_hours("timestamp", late).alias("timestamp"))


def bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bid-curve stand-in in the ``bid_curves`` shape (one row per line item)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        tc.trunc_day("l_shipdate").alias("timestamp"), F.lit("XX").alias("country"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("generator_id"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price_eur_mwh"),
        F.col("l_quantity").alias("quantity_mw"), F.col("l_linestatus").alias("bid_type"),
        F.col("l_returnflag").alias("technology"))


def sided_bids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bids with a side: odd lines of an order offer, even lines ask; one market per ship day."""
    li = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_linenumber", "l_extendedprice", "l_quantity")
    side = F.when(F.col("l_linenumber") % 2 == 1, "supply").otherwise("demand")
    return li.select(tc.trunc_day("l_shipdate").alias("timestamp"), F.try_divide("l_extendedprice", "l_quantity").alias("price_eur_mwh"),
                     F.col("l_quantity").cast("double").alias("quantity_mw"), side.alias("bid_type"))
