"""Adapter: readings out of ``lineitem``, ``supplier`` and ``nation``.

One line item is one reading of one place (the supplier) on one day (the ship date), with gaps,
negative and out-of-range values.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Unique, deterministic order of readings.
ORDER = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]

_COUNTRY = """CASE n_regionkey WHEN 0 THEN 'USA' WHEN 1 THEN 'France' WHEN 2 THEN 'India'
                               WHEN 3 THEN 'Brazil' ELSE 'Egypt' END"""


#: places that are broadcast to their readings (about 100 bytes each); beyond it Spark decides, by shuffle as a rule
MOST_PLACES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and country of each supplier."""
    return table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", F.col("s_name").alias("city"), F.expr(_COUNTRY).alias("country"))


def _small(spark: SparkSession, sf_dir: str, table_of_places: DataFrame) -> DataFrame:
    """A table with a row per place at most, to be broadcast if places are few. They are counted, which reads no column."""
    return F.broadcast(table_of_places) if table(spark, sf_dir, "supplier").count() <= MOST_PLACES else table_of_places


def city_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """city -> country, one row per city."""
    return _small(spark, sf_dir, places(spark, sf_dir).groupBy("city").agg(F.min("country").alias("country")))


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """country -> its first city by name."""
    return _small(spark, sf_dir, places(spark, sf_dir).groupBy("country").agg(F.min("city").alias("city")))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings: order columns, ``ts`` (session time), place and ten measurements.

    Spark takes the product of both sizes for what a join of suppliers and nations leaves, so it would deal all readings by place, though
    places are few. They are counted, which reads no column, and broadcast.
    """
    gap = lambda rule, value: F.expr(f"CASE WHEN {rule} THEN NULL ELSE {value} END")
    place = _small(spark, sf_dir, places(spark, sf_dir).withColumnsRenamed({"city": "_city", "country": "_country"}))
    return table(spark, sf_dir, "lineitem").join(
        place, F.col("l_suppkey") == F.col("s_suppkey")
    ).select(
        *ORDER,
        gap("(l_orderkey + l_partkey) % 29 = 0", "CAST(l_shipdate AS TIMESTAMP)").alias("ts"),
        gap("l_partkey % 101 = 0", "_city").alias("city"),
        gap("l_partkey % 103 = 0", "_country").alias("country"),
        F.expr("""CASE WHEN (l_orderkey + l_linenumber) % 13 = 0 THEN NULL
                       WHEN l_orderkey % 97 = 0 THEN -l_quantity ELSE l_quantity * 10 END""").alias("AQI"),
        gap("l_partkey % 11 = 0", "l_extendedprice / 200").alias("pm25_ugm3"),
        gap("l_partkey % 17 = 0", "l_extendedprice / 160").alias("pm10_ugm3"),
        gap("l_orderkey % 19 = 0", "CAST(l_orderkey % 2100 AS DOUBLE) / 5").alias("no2_ppb"),
        F.expr("CAST((l_partkey * 7) % 1050 AS DOUBLE)").alias("so2_ppb"),
        F.expr("CAST((l_orderkey * 3) % 520 AS DOUBLE) / 10").alias("co_ppm"),
        F.expr("CAST((l_partkey * 11) % 620 AS DOUBLE) / 2").alias("o3_ppb"),
        F.expr("CAST(l_orderkey % 150 - 60 AS DOUBLE)").alias("temp_c"),
        F.expr("CAST(l_partkey % 121 - 10 AS DOUBLE)").alias("humidity_pct"),
        F.expr("CAST(l_suppkey % 17 - 1 AS DOUBLE)").alias("wind_ms"),
    )
