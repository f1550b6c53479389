"""Readings as a city / day / reading graph of node and edge tables, and the queries over it.

A city is known by country and name, so equal names in two countries stay apart. The reading's own
key holds the keys of its city and day, so queries need no join along those edges.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from airlens import config as C
from airlens.functions import stable_round
from airlens.operators.clean import first_per_key

CITY, READING = ["country", "city"], ["country", "city", "event_date"]
_FLAGS = [f"{C.short(p)}_exceeds_who" for p in C.POLLUTANTS]
#: table -> its key
KEYS = {
    "city": CITY, "day": ["event_date"], "reading": READING, "category": ["aqi_category"],
    "compliant": READING, "has_reading": READING, "on_day": READING,
    "has_category": [*READING, "aqi_category"], "has_compliant": READING,
}
#: table -> attributes taken from the first reading of a key
ATTRIBUTES = {
    "city": ["hemisphere"],
    "day": ["year", "month", "day", "day_of_week", "season"],
    "reading": [*C.MEASUREMENTS, "pm_ratio"],
    "compliant": [*_FLAGS, "who_compliant_all"],
}
#: tie order of pollutants in reports
POLLUTANT_ORDER = ["pm25", "pm10", "no2", "o3", "so2", "co"]


#: readings that are dealt together, and in which one place and day is looked for
PART_ROWS = 200_000
#: a place and day with more readings of a load than this is cut down before the shuffle
HOT_ROWS = 1_000


def month() -> Column:
    """The month a row with a day is stored in."""
    return F.date_format("event_date", "yyyy-MM")


def _shares(rows: DataFrame) -> tuple[dict[str, int], list[int]]:
    """Rows per ``stored_month``, and hashes of places and days that hold very many of them.

    One scan without a shuffle of rows: a sketch per month names its most frequent hashes. A hash it misses, or names in vain, changes
    the way of its rows and not the result.
    """
    found = rows.groupBy("stored_month").agg(F.count("*").alias("n"), F.expr("approx_top_k(_hash, 100, 2000)").alias("top")).collect()
    return {r["stored_month"]: r["n"] for r in found}, sorted({t["item"] for r in found for t in r["top"] if t["count"] > HOT_ROWS})


def _stage_graph(good: DataFrame, order_by: Sequence[str], stage: str, known: DataFrame | None) -> DataFrame:
    """The first reading of each place and day that is new, with the category links that are new (``links``), in files by month.

    Readings, and the stored links of their months, are dealt by month and part of a month in one shuffle, which serves the choice, the
    look for stored keys and the files. A row whose place and day is ``_stored`` has new links only.
    """
    spark, at = good.sparkSession, F.xxhash64(*READING)
    attributes = dict.fromkeys([*order_by, *READING, *[c for extra in ATTRIBUTES.values() for c in extra]])
    rows = good.select(*dict.fromkeys([*attributes, "aqi_category"]), month().alias("stored_month"), at.alias("_hash"))
    months, hot = _shares(rows)
    if hot:
        often = rows.where(F.col("_hash").isin(hot))
        rows = rows.where(~F.col("_hash").isin(hot)).unionByName(first_per_key(often, KEYS["has_category"], order_by))
    rows = rows.withColumn("_stored", F.lit(False))
    if known is not None:
        known = known.where(F.col("stored_month").isin(list(months)))
        for r in known.groupBy("stored_month").count().collect():
            months[r["stored_month"]] += r["count"]
        known = known.select(*KEYS["has_category"], "stored_month", at.alias("_hash"), F.lit(True).alias("_stored"))
        rows = rows.unionByName(known, allowMissingColumns=True)
    parts = spark.createDataFrame([(month, -(-n // PART_ROWS)) for month, n in months.items()], "stored_month string, _parts long")
    # a row per month; of a size unknown to Spark, which would deal the readings by month first and then again by part
    dealt = (rows.join(F.broadcast(parts), "stored_month").withColumn("_part", F.pmod("_hash", "_parts")).drop("_hash", "_parts")
             .repartition("stored_month", "_part"))
    one = W.partitionBy("stored_month", "_part", *READING)
    links = F.array_except(F.collect_set("aqi_category").over(one), F.collect_set(F.when(F.col("_stored"), F.col("aqi_category"))).over(one))
    firsts = (dealt.withColumn("_rank", F.row_number().over(one.orderBy(F.desc("_stored"), *order_by))).withColumn("links", links)
              .where((F.col("_rank") == 1) & (~F.col("_stored") | (F.size("links") > 0)))
              .select(*attributes, "_stored", "links", "stored_month"))
    firsts.write.mode("overwrite").partitionBy("stored_month").parquet(f"{stage}/firsts")
    return spark.read.schema(firsts.schema).parquet(f"{stage}/firsts")


def build_graph(df: DataFrame, order_by: Sequence[str], stage: str | None = None,
                known: DataFrame | None = None) -> dict[str, DataFrame]:
    """Node and edge tables by name, and ``rejects``: readings with a missing key.

    Attributes of a node come from the first reading with its key, in ``order_by`` order. The first
    reading of a city or of a day is also the first of its own key, so all nodes come from one
    reduced table; a place and day with very many readings is cut down before any shuffle. With
    ``stage``, a path, this table is written there once, by month, and read back: for storing the whole graph. ``known``, the stored
    ``has_category`` with its ``stored_month``, then leaves only what is new; it must hold every stored reading.
    """
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in [*READING, "aqi_category"]])
    good = df.filter(complete)
    if stage:
        staged = _stage_graph(good, order_by, stage, known)
        firsts = staged.where("NOT _stored")
        links = staged.select(*READING, F.explode("links").alias("aqi_category"))
    else:
        columns = dict.fromkeys([*order_by, *READING, *[c for extra in ATTRIBUTES.values() for c in extra]])
        firsts = first_per_key(good.select(*columns), READING, order_by)
        links = good.select(*KEYS["has_category"]).distinct()
    nodes = {
        name: (firsts if KEYS[name] == READING else first_per_key(firsts, KEYS[name], order_by))
        .select(*KEYS[name], *extra) for name, extra in ATTRIBUTES.items()}
    keys = firsts.select(*READING)
    return {
        **nodes,
        "category": links.select("aqi_category").distinct(),
        "has_reading": keys, "on_day": keys, "has_compliant": keys, "has_category": links,
        "rejects": df.filter(~complete),
    }


def _between(df: DataFrame, start: str, end: str) -> DataFrame:
    day = F.col("event_date")
    return df.filter((day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date")))


def top_cities_by_avg_aqi(graph: dict[str, DataFrame], start: str, end: str, k: int = 5) -> DataFrame:
    """Cities with the highest average AQI from ``start`` to ``end``, both included."""
    return (
        _between(graph["reading"], start, end)
        .groupBy("city", "country").agg(stable_round(F.avg("AQI"), 2).alias("avg_aqi"))
        .orderBy(F.col("avg_aqi").desc_nulls_last(), "city", "country").limit(k)
    )


def pollution_driver_per_city(
    graph: dict[str, DataFrame], start: str = "2024-01-01", end: str = "2024-12-31",
    limit: int | None = 10,
) -> DataFrame:
    """Days above the guideline per city and pollutant, and their total.

    Only flags inside the dates are counted, but every city with any reading is listed: one aggregate over the readings'
    flags, with the dates inside the counts, so no city list is needed.
    """
    day = F.col("event_date")
    within = (day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date"))
    shown = ["pm25", "pm10", "no2", "so2", "co", "o3"]
    counts = graph["compliant"].groupBy(*CITY).agg(*[
        F.count_if(within & (F.col(f"{p}_exceeds_who") == "Yes")).alias(p) for p in shown])
    total = reduce(Column.__add__, [F.col(p) for p in shown])
    result = (
        counts.select("country", "city", *shown, total.alias("total_exceed"))
        .orderBy(F.desc("total_exceed"), "city", "country")
    )
    return result if limit is None else result.limit(limit)


def linked_readings(graph: dict[str, DataFrame], start: str, end: str) -> DataFrame:
    """``reading`` from ``start`` to ``end``, followed along its edges: those that their city, their day and their compliance node
    are all stored for. In a store some tables may hold a load that broke off before others; such readings are left out.

    Edges carry the keys of both ends, so each hop is a semi join on a key; tables read by month prune on all hops.
    """
    rows = _between(graph["reading"], start, end)
    for edge, node in (("has_reading", "city"), ("on_day", "day"), ("has_compliant", "compliant")):
        ends = _between(graph[node], start, end) if "event_date" in KEYS[node] else graph[node]
        hop = _between(graph[edge], start, end).join(ends.select(*KEYS[node]), KEYS[node], "left_semi")
        rows = rows.join(hop.select(*READING), READING, "left_semi")
    return rows


def pollution_driver_of_cities(graph: dict[str, DataFrame], start: str, end: str, limit: int | None = 10) -> DataFrame:
    """:func:`pollution_driver_per_city` on a store: the ``city`` nodes say who is listed, so compliance nodes are read for the
    months of ``start`` to ``end`` alone."""
    counts = pollution_driver_per_city(
        {"compliant": _between(graph["compliant"], start, end)}, start, end, limit=None)
    numbers = [c for c in counts.columns if c not in CITY]
    listed = (graph["city"].select(*CITY).join(counts, CITY, "left").fillna(0, numbers).select(*CITY, *numbers)
              .orderBy(F.desc("total_exceed"), "city", "country"))
    return listed if limit is None else listed.limit(limit)


def rank_pollutants(drivers: DataFrame) -> DataFrame:
    """Per city, its six pollutants by days above the guideline; ties in a fixed order."""
    order = F.array_position(F.array(*map(F.lit, POLLUTANT_ORDER)), F.col("pollutant"))
    ranked = W.partitionBy(*CITY).orderBy(F.desc("days"), order)
    return (drivers.unpivot([*CITY], POLLUTANT_ORDER, "pollutant", "days")
            .withColumn("pollutant_rank", F.row_number().over(ranked)))
