"""Small reports over the result tables of the live pipeline."""

from pyspark.sql import DataFrame, Window as W, functions as F


def top_by(df: DataFrame, value: str, k: int, columns: list[str], ties: list[str]) -> DataFrame:
    """The ``k`` rows with the largest ``value``; ``ties`` makes the choice repeatable."""
    return df.orderBy(F.col(value).desc_nulls_last(), *ties).limit(k).select(*columns)


def top_cities(metrics: DataFrame, k: int = 5) -> DataFrame:
    """City windows with the highest average AQI."""
    return top_by(metrics, "avg_aqi", k, ["city", "country", "avg_aqi", "max_aqi", "who_violations",
                                          "measurement_count"], ["city", "country", "window_start"])


def top_countries(trends: DataFrame, k: int = 5) -> DataFrame:
    """Country windows with the highest average AQI."""
    return top_by(trends, "country_avg_aqi", k,
                  ["country", "country_avg_aqi", "unhealthy_percentage", "hazardous_count"],
                  ["country", "window_start"])


def latest_alerts(alerts: DataFrame, priority: int | None = None, k: int = 5,
                  clock: str = "alert_timestamp", ties: tuple[str, ...] = ("city",)) -> DataFrame:
    """The newest alerts, all or only up to a priority number."""
    if priority is not None:
        alerts = alerts.filter(F.col("alert_priority") <= priority)
        shown = ["city", "AQI", "alert_priority", "alert_message"]
    else:
        shown = ["city", "AQI", "health_risk_label"]
    return top_by(alerts, clock, k, shown, list(ties))


def top_city_stats(stats: DataFrame, k: int = 10) -> DataFrame:
    """Cities with the highest overall average AQI."""
    return top_by(stats, "avg_aqi", k, ["city", "country", "avg_aqi", "max_aqi", "count"],
                  ["city", "country"])


def risk_distribution(alerts: DataFrame) -> DataFrame:
    """Alerts per risk label and their share in percent. The total runs over six counts."""
    share = F.col("n") / F.sum("n").over(W.partitionBy())
    return (alerts.groupBy("health_risk_label").agg(F.count("*").alias("n"))
            .withColumn("share_pct", F.round(share * 100, 1)))


def aqi_histogram(stats: DataFrame, bins: int = 20, value: str = "avg_aqi") -> DataFrame:
    """Cities per equal-width bin between the smallest and the largest average; all bins listed.

    The last bin includes its upper edge. If all averages are equal, the range is half a unit to
    both sides.
    """
    known = stats.filter(F.col(value).isNotNull())
    ends = known.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    flat = F.when(F.col("lo") == F.col("hi"), 0.5).otherwise(0.0)
    ends = ends.select(F.struct((F.col("lo") - flat).alias("lo"), (F.col("hi") + flat).alias("hi")))
    placed = known.select(F.col(value).alias("v"), ends.scalar().alias("e"))
    at = F.floor((F.col("v") - F.col("e.lo")) / (F.col("e.hi") - F.col("e.lo")) * bins)
    counts = (placed.groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin"))
              .agg(F.count("*").alias("n")))
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    slots = stats.sparkSession.range(bins).select(
        F.col("id").cast("int").alias("bin"), ends.scalar().alias("e"))
    return slots.join(counts, "bin", "left").select(
        "bin",
        (F.col("e.lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("e.lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def summary(stats: DataFrame, alerts: DataFrame, critical: float = 200) -> DataFrame:
    """Number of cities, mean of their averages, highest AQI, and alerts above ``critical``."""
    high = alerts.filter(F.col("AQI") > critical).agg(F.count("*").alias("n"))
    return stats.agg(
        F.count("*").alias("cities"),
        F.round(F.avg("avg_aqi"), 2).alias("avg_global_aqi"),
        F.max("max_aqi").alias("max_aqi"),
    ).select("*", high.scalar().alias("critical_alerts"))
