"""Row-wise queries: enrichment, validation, risk and alerts."""

from pyspark.sql import functions as F

from airlens import config as C
from airlens.catalog import sql
from airlens.catalog.inputs import enriched, with_corrupt
from airlens.catalog.registry import query
from airlens.operators import enrich as E, risk as R, validate as V
from airlens.operators.clean import with_event_date
from airlens.sources.readings import ORDER, readings


def _over_readings(columns: str, *steps) -> str:
    source = steps[-1][0] if steps else "readings"
    return sql.chain(*steps, last=f"SELECT {sql.KEYS}, {columns} FROM {source}")


_DATED = sql.ENRICHED[:1]


@query("e01_event_date", _over_readings("CAST(event_date AS VARCHAR) AS event_date", *_DATED))
def e01(spark, sf):
    return readings(spark, sf).transform(with_event_date).select(*ORDER, "event_date")


@query("e02_calendar", _over_readings(sql.CALENDAR, *_DATED))
def e02(spark, sf):
    df = readings(spark, sf).transform(with_event_date).transform(E.add_calendar)
    return df.select(*ORDER, "year", "month", "day", "day_of_week")


@query("e03_hemisphere", _over_readings(f"city, {sql.HEMISPHERE} AS hemisphere"))
def e03(spark, sf):
    return readings(spark, sf).select(
        *ORDER, "city", E.hemisphere(F.col("city"), sql.SOUTHERN).alias("hemisphere"))


@query("e04_season", _over_readings("hemisphere, season", *sql.ENRICHED))
def e04(spark, sf):
    df = readings(spark, sf).transform(with_event_date).transform(E.add_season, sql.SOUTHERN)
    return df.select(*ORDER, "hemisphere", "season")


@query("e05_pm_ratio", _over_readings(f"{sql.PM_RATIO} AS pm_ratio"))
def e05(spark, sf):
    return readings(spark, sf).select(*ORDER, E.pm_ratio().alias("pm_ratio"))


@query("e06_aqi_category", _over_readings(f"{sql.CATEGORY} AS aqi_category"))
def e06(spark, sf):
    return readings(spark, sf).select(*ORDER, E.aqi_category().alias("aqi_category"))


@query("e07_pollutant_buckets", _over_readings(sql.BUCKETS))
def e07(spark, sf):
    df = readings(spark, sf).transform(E.add_buckets)
    return df.select(*ORDER, *[c for c in df.columns if c.startswith("aqi_bucket_")])


@query("e08_exceeds_who", _over_readings(sql.FLAGS))
def e08(spark, sf):
    df = readings(spark, sf).transform(E.add_who_flags)
    return df.select(*ORDER, *[c for c in df.columns if c.endswith("_exceeds_who")])


@query("e09_who_compliant_all", _over_readings(sql.COMPLIANT))
def e09(spark, sf):
    return readings(spark, sf).transform(E.add_who_flags).select(*ORDER, "who_compliant_all")


# --- validation -----------------------------------------------------------------
_FLAGGED = [("flagged", sql.flagged("readings"))]


@query("v01_is_number", _over_readings(", ".join(
    f"{c} IS NOT NULL AND NOT isnan({c}) AS {c}_ok" for c in C.MEASUREMENTS)))
def v01(spark, sf):
    return readings(spark, sf).select(
        *ORDER, *[V.is_number(F.col(c)).alias(f"{c}_ok") for c in C.MEASUREMENTS])


@query("v02_temp_ok", _over_readings(f"{sql.TEMP_OK} AS temp_ok"))
def v02(spark, sf):
    return readings(spark, sf).select(*ORDER, V.temp_ok(F.col("country"), F.col("temp_c")).alias("temp_ok"))


@query("v03_aqi_ok", _over_readings(f"{sql.CHECKS['AQI_INVALID']} AS aqi_ok"))
def v03(spark, sf):
    return readings(spark, sf).select(*ORDER, V.aqi_ok(F.col("AQI")).alias("aqi_ok"))


@query("v04_is_valid", _over_readings("is_valid", *_FLAGGED))
def v04(spark, sf):
    return readings(spark, sf).transform(with_corrupt).transform(V.add_is_valid).select(*ORDER, "is_valid")


@query("v05_split", sql.chain(*_FLAGGED, last=(
    f"SELECT {sql.KEYS}, CASE WHEN is_valid THEN 'valid' ELSE 'invalid' END AS part FROM flagged")))
def v05(spark, sf):
    valid, invalid, _ = V.split_valid(with_corrupt(readings(spark, sf)))
    return (valid.select(*ORDER, F.lit("valid").alias("part"))
            .unionByName(invalid.select(*ORDER, F.lit("invalid").alias("part"))))


def _labeled(spark, sf):
    _, _, labeled = V.split_valid(with_corrupt(readings(spark, sf)))
    return labeled


@query("v06_error_codes", sql.chain(*_FLAGGED, last=(
    f"SELECT {sql.KEYS}, error_codes FROM flagged WHERE NOT is_valid")))
def v06(spark, sf):
    return _labeled(spark, sf).select(*ORDER, F.array_join("error_codes", ",").alias("error_codes"))


_FIRST = "nullif(split_part(error_codes, ',', 1), '')"


@query("v07_error_code", sql.chain(*_FLAGGED, last=(
    f"SELECT {sql.KEYS}, {_FIRST} AS error_code FROM flagged WHERE NOT is_valid")))
def v07(spark, sf):
    return _labeled(spark, sf).select(*ORDER, "error_code")


_SHOWN = {"country": "country", "city": "city", "temp_c": "temp_c", "humidity": "humidity_pct",
          "wind_ms": "wind_ms", "AQI": "AQI"}
_PARTS = ", ".join(f"'{label}=' || CAST({c} AS VARCHAR)" for label, c in _SHOWN.items())
_VALUES = ", ".join(f"CAST({p} AS VARCHAR)" for p in C.POLLUTANTS)


@query("v08_error_message", sql.chain(*_FLAGGED, last=(
    f"SELECT {sql.KEYS}, concat_ws(' | ', 'failed validation', {_PARTS}, "
    f"'pollutants=' || concat_ws(',', {_VALUES})) AS error_message FROM flagged WHERE NOT is_valid")))
def v08(spark, sf):
    return _labeled(spark, sf).select(*ORDER, "error_message")


@query("v09_ingest_ts", sql.chain(*_FLAGGED, last=(
    f"SELECT {sql.KEYS}, TRUE AS stamped FROM flagged WHERE NOT is_valid")))
def v09(spark, sf):
    stamped = F.col("ingest_ts").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$")
    return _labeled(spark, sf).select(*ORDER, stamped.alias("stamped"))


@query("v10_error_histogram", sql.chain(*_FLAGGED, last=(
    f"SELECT {_FIRST} AS error_code, count(*) AS count FROM flagged WHERE NOT is_valid GROUP BY 1")))
def v10(spark, sf):
    return _labeled(spark, sf).transform(V.error_histogram)


# --- risk and alerts --------------------------------------------------------------
RISK = (f"CASE WHEN AQI IS NULL THEN 6 ELSE {sql.labels('AQI', C.AQI_CUTS, [1, 2, 3, 4, 5, 6])} END")
RISK_LABEL = f"CASE WHEN AQI IS NULL THEN 'Hazardous' ELSE {sql.labels('AQI', C.AQI_CUTS, C.RISK_LABELS)} END"
SCORE = """(CASE WHEN wind_ms > 5 THEN CAST(-0.3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
  + CASE WHEN humidity_pct > 70 THEN CAST(0.2 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
  + CASE WHEN temp_c > 30 THEN CAST(0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
  + CASE WHEN temp_c < 10 THEN CAST(0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"""
ADJUSTED = sql.half_up(f"AQI * (1 + {SCORE})", 2)
CONDITION = """CASE WHEN wind_ms > 8 THEN 'Windy' WHEN humidity_pct > 80 THEN 'Humid'
  WHEN temp_c > 35 THEN 'Hot' WHEN temp_c < 5 THEN 'Cold' ELSE 'Normal' END"""
PRIMARY = """CASE WHEN pm25_ugm3 > pm10_ugm3 AND pm25_ugm3 > no2_ppb AND pm25_ugm3 > so2_ppb THEN 'PM2.5'
  WHEN pm10_ugm3 > pm25_ugm3 AND pm10_ugm3 > no2_ppb AND pm10_ugm3 > so2_ppb THEN 'PM10'
  WHEN no2_ppb > so2_ppb THEN 'NO2' ELSE 'SO2' END"""
SOURCE = """CASE primary_pollutant WHEN 'PM2.5' THEN 'Vehicle/Industrial Emissions'
  WHEN 'PM10' THEN 'Construction/Dust' WHEN 'NO2' THEN 'Traffic Emissions' ELSE 'Industrial Activity' END"""
FACTOR = "CAST(CASE season WHEN 'Winter' THEN 1.2 WHEN 'Summer' THEN 0.9 ELSE 1.0 END AS DOUBLE)"
PRIORITY = """CASE WHEN AQI > 300 THEN 1 WHEN AQI > 200 AND who_compliant_all = 'No' THEN 2
  WHEN AQI > 150 AND pm25_exceeds_who = 'Yes' THEN 3 WHEN AQI > 100 THEN 4 ELSE 5 END"""
MESSAGE = "CASE alert_priority " + " ".join(
    f"WHEN {p} THEN '{before}' || city || '{after}'" for p, (before, after) in C.ALERT_TEXTS.items()) + " END"
ALERTS = [*sql.ENRICHED, ("alerts", f"""SELECT *, {SOURCE} AS pollution_source, {MESSAGE} AS alert_message,
  {sql.half_up(f'AQI * seasonal_factor', 2)} AS seasonal_adjusted_aqi
FROM (SELECT *, {RISK} AS health_risk_score, {RISK_LABEL} AS health_risk_label,
  {SCORE} AS weather_impact_score, {ADJUSTED} AS adjusted_aqi, {CONDITION} AS weather_condition,
  {PRIMARY} AS primary_pollutant, {FACTOR} AS seasonal_factor, {PRIORITY} AS alert_priority
  FROM enriched) AS a""")]


def _of_alerts(*columns):
    return _over_readings(", ".join(columns), *ALERTS)


def _risk_query(name, transform, *columns):
    @query(name, _of_alerts(*columns))
    def run(spark, sf):
        return enriched(spark, sf).transform(transform).select(*ORDER, *columns)


_risk_query("t5_07_08_health_risk", R.add_health_risk, "health_risk_score", "health_risk_label")
_risk_query("t5_09_11_weather_impact", R.add_weather_impact,
            "weather_impact_score", "adjusted_aqi", "weather_condition")
_risk_query("t5_12_15_pollution_source", R.add_pollution_source,
            "primary_pollutant", "pollution_source", "seasonal_factor", "seasonal_adjusted_aqi")
_risk_query("t5_16_17_alert", R.add_alert, "alert_priority", "alert_message")


@query("t5_18_alert_timestamp", sql.chain(last=f"SELECT {sql.KEYS}, TRUE AS stamped FROM readings"))
def t5_18(spark, sf):
    df = enriched(spark, sf).transform(R.add_alert)
    return df.select(*ORDER, F.col("alert_timestamp").isNotNull().alias("stamped"))


@query("t5_19_filter_critical", sql.chain(last=f"SELECT {sql.KEYS}, AQI FROM readings WHERE AQI >= 150"))
def t5_19(spark, sf):
    return readings(spark, sf).transform(R.filter_critical).select(*ORDER, "AQI")


@query("t5_20_urgent_alerts", sql.chain(*ALERTS, last=(
    f"SELECT {sql.KEYS}, {', '.join(R.ALERT_VIEW)} FROM alerts WHERE alert_priority <= 3")))
def t5_20(spark, sf):
    return (enriched(spark, sf).transform(R.alerts, clock=False).transform(R.urgent_alerts)
            .select(*ORDER, *R.ALERT_VIEW))


@query("t5_20_alert_view", sql.chain(*ALERTS, last=(
    f"SELECT {', '.join(R.ALERT_VIEW)} FROM alerts WHERE alert_priority <= 3")))
def t5_20_view(spark, sf):
    return (enriched(spark, sf).transform(R.alerts, clock=False).transform(R.urgent_alerts)
            .transform(R.alert_view))
