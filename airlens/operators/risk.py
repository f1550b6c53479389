"""Row transforms of the live pipeline: risk, weather, source, alerts. Batch and stream alike."""

from pyspark.sql import Column, DataFrame, functions as F

from airlens import config as C
from airlens.functions import bucketize, first_match

ALERT_VIEW = ["city", "country", "AQI", "health_risk_label", "primary_pollutant",
              "alert_priority", "alert_message"]


def _compare(column: str, sign: str, threshold: float) -> Column:
    value = F.col(column)
    return value > threshold if sign == ">" else value < threshold


def add_health_risk(df: DataFrame) -> DataFrame:
    """``health_risk_score`` 1..6 and its label. An unknown AQI is rated as the worst."""
    steps = range(1, len(C.RISK_LABELS) + 1)
    rate = lambda names: F.coalesce(bucketize(F.col("AQI"), C.AQI_CUTS, names), F.lit(names[-1]))
    return df.withColumns({
        "health_risk_score": rate(list(steps)), "health_risk_label": rate(C.RISK_LABELS),
    })


def add_weather_impact(df: DataFrame) -> DataFrame:
    """``weather_impact_score``, ``adjusted_aqi`` and ``weather_condition``."""
    score = None
    for column, sign, threshold, weight in C.WEATHER_WEIGHTS:
        term = F.when(_compare(column, sign, threshold), F.lit(weight)).otherwise(F.lit(0.0))
        score = term if score is None else score + term
    condition = first_match(
        [(_compare(column, sign, threshold), F.lit(name))
         for column, sign, threshold, name in C.WEATHER_CONDITIONS], F.lit(C.WEATHER_DEFAULT))
    return df.withColumns({
        "weather_impact_score": score,
        "adjusted_aqi": F.round(F.col("AQI") * (1 + score), 2),
        "weather_condition": condition,
    })


def primary_pollutant() -> Column:
    """The strictly largest of the particles and the two gases. A tie, or an unknown value, leaves
    the particles out and the gases decide."""
    pm25, pm10, no2, so2 = (F.col(c) for c in ("pm25_ugm3", "pm10_ugm3", "no2_ppb", "so2_ppb"))
    return first_match([
        ((pm25 > pm10) & (pm25 > no2) & (pm25 > so2), F.lit("PM2.5")),
        ((pm10 > pm25) & (pm10 > no2) & (pm10 > so2), F.lit("PM10")),
        (no2 > so2, F.lit("NO2")),
    ], F.lit("SO2"))


def add_pollution_source(df: DataFrame) -> DataFrame:
    """``primary_pollutant``, ``pollution_source``, ``seasonal_factor``, ``seasonal_adjusted_aqi``."""
    df = df.withColumn("primary_pollutant", primary_pollutant())
    source = first_match([(F.col("primary_pollutant") == p, F.lit(s))
                          for p, s in C.POLLUTION_SOURCES.items()], F.lit(C.POLLUTION_SOURCE_DEFAULT))
    factor = first_match([(F.col("season") == s, F.lit(f)) for s, f in C.SEASONAL_FACTORS.items()],
                         F.lit(C.SEASONAL_FACTOR_DEFAULT))
    return df.withColumns({
        "pollution_source": source,
        "seasonal_factor": factor,
        "seasonal_adjusted_aqi": F.round(F.col("AQI") * factor, 2),
    })


def alert_priority() -> Column:
    """1 (act now) to 5 (fine, or AQI unknown)."""
    def holds(limit, flag):
        above = F.col("AQI") > limit
        return above & (F.col(flag[0]) == flag[1]) if flag else above

    return first_match([(holds(*rule), F.lit(p)) for p, rule in C.ALERT_RULES.items()], F.lit(C.ALERT_CALM))


def add_alert(df: DataFrame, clock: bool = True) -> DataFrame:
    """``alert_priority``, ``alert_message`` and, with ``clock``, ``alert_timestamp``."""
    df = df.withColumn("alert_priority", alert_priority())
    text = lambda p: F.concat(F.lit(C.ALERT_TEXTS[p][0]), "city", F.lit(C.ALERT_TEXTS[p][1]))
    *urgent, calm = sorted(C.ALERT_TEXTS)
    message = first_match([(F.col("alert_priority") == p, text(p)) for p in urgent], text(calm))
    df = df.withColumn("alert_message", message)
    return df.withColumn("alert_timestamp", F.current_timestamp()) if clock else df


def alerts(df: DataFrame, clock: bool = True) -> DataFrame:
    """All four transforms."""
    return (df.transform(add_health_risk).transform(add_weather_impact)
            .transform(add_pollution_source).transform(add_alert, clock))


def filter_critical(df: DataFrame, threshold: float = 150) -> DataFrame:
    return df.filter(F.col("AQI") >= threshold)


def urgent_alerts(df: DataFrame, priority: int = 3) -> DataFrame:
    """Alerts of at most this priority number."""
    return df.filter(F.col("alert_priority") <= priority)


def alert_view(df: DataFrame) -> DataFrame:
    """The seven columns shown on the console."""
    return df.select(*ALERT_VIEW)
