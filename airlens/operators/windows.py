"""Sliding-window aggregates. The same functions serve a table and a stream.

On a table the watermark has no effect. On a stream, ``append`` and ``update`` output drop state
behind the watermark; ``complete`` keeps every window for ever, so it is for small results only.
"""

from pyspark.sql import DataFrame, functions as F

from airlens.functions import safe_corr, stable_round


def _windowed(df: DataFrame, width: str, slide: str, late: str, *keys):
    return df.withWatermark("ts", late).groupBy(F.window("ts", width, slide).alias("w"), *keys)


def city_metrics(df: DataFrame, width: str = "2 minutes", slide: str = "1 minute",
                 late: str = "2 minutes") -> DataFrame:
    """Averages, extremes, count and guideline violations per city."""
    return (
        _windowed(df, width, slide, late, "city", "country")
        .agg(
            stable_round(F.avg("AQI"), 2).alias("avg_aqi"),
            F.max("AQI").alias("max_aqi"),
            F.min("AQI").alias("min_aqi"),
            stable_round(F.avg("pm25_ugm3"), 2).alias("avg_pm25"),
            stable_round(F.avg("pm10_ugm3"), 2).alias("avg_pm10"),
            stable_round(F.avg("temp_c"), 1).alias("avg_temp"),
            stable_round(F.avg("humidity_pct"), 1).alias("avg_humidity"),
            F.count("*").alias("measurement_count"),
            F.count_if(F.col("who_compliant_all") == "No").alias("who_violations"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "*").drop("w")
    )


def country_trends(df: DataFrame, width: str = "3 minutes", slide: str = "1 minute",
                   late: str = "2 minutes") -> DataFrame:
    """Average, spread, median and share of unhealthy readings per country.

    The median is a sketch: it works on streams and its state is bounded.
    """
    unhealthy, total = F.col("unhealthy_count"), F.col("total_readings")
    return (
        _windowed(df, width, slide, late, "country")
        .agg(
            stable_round(F.avg("AQI"), 2).alias("country_avg_aqi"),
            stable_round(F.stddev("AQI"), 2).alias("aqi_stddev"),
            F.round(F.percentile_approx("AQI", 0.5), 2).alias("median_aqi"),
            F.count_if(F.col("AQI") > 200).alias("hazardous_count"),
            F.count_if(F.col("AQI") > 150).alias("unhealthy_count"),
            F.count("*").alias("total_readings"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*",
                F.round(unhealthy / total * 100, 2).alias("unhealthy_percentage")).drop("w")
    )


def pollutant_correlations(df: DataFrame, width: str = "5 minutes", slide: str = "2 minutes",
                           late: str = "2 minutes") -> DataFrame:
    """Correlation of the AQI with three pollutants, and averages, over all places."""
    partners = {"pm25": "pm25_ugm3", "pm10": "pm10_ugm3", "no2": "no2_ppb"}
    averages = {"global_avg_pm25": "pm25_ugm3", "global_avg_pm10": "pm10_ugm3", "global_avg_aqi": "AQI"}
    return (
        _windowed(df, width, slide, late)
        .agg(
            *[stable_round(safe_corr(F.col(c), F.col("AQI")), 3).alias(f"{name}_aqi_corr")
              for name, c in partners.items()],
            *[stable_round(F.avg(c), 2).alias(name) for name, c in averages.items()],
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "*").drop("w")
    )


def city_stats(df: DataFrame) -> DataFrame:
    """Average and maximum AQI and count per city, over everything seen."""
    return df.groupBy("city", "country").agg(
        F.avg("AQI").alias("avg_aqi"), F.max("AQI").alias("max_aqi"),
        F.count("*").alias("count"))
