"""Dashboard queries over windowed metrics, alerts and city statistics."""

from pyspark.sql import functions as F

from airlens.catalog import sql
from airlens.catalog.inputs import enriched
from airlens.catalog.live import CITY_SQL, COUNTRY_SQL, DAY, _live, _stored_stats
from airlens.catalog.registry import ORACLES, query
from airlens.catalog.rows import ALERTS
from airlens.operators import dashboard as B, risk as R, windows as W
from airlens.sources.readings import ORDER

_STATS = ("stats", "SELECT city, country, round(avg(AQI), 6) AS avg_aqi, max(AQI) AS max_aqi, "
                   "count(*) AS count FROM readings GROUP BY city, country")


def _alerts(spark, sf):
    """Alerts on the readings' own clock, so that "latest" can be checked."""
    return enriched(spark, sf).transform(R.alerts, clock=False).withColumn("alert_timestamp", F.col("ts"))


def _stats(spark, sf):
    return enriched(spark, sf).transform(W.city_stats).withColumn("avg_aqi", F.round("avg_aqi", 6))


@query("d01_top_cities", sql.chain(*sql.ENRICHED, ("m", CITY_SQL), last=(
    "SELECT city, country, avg_aqi, max_aqi, who_violations, measurement_count FROM m "
    "ORDER BY avg_aqi DESC NULLS LAST, city NULLS FIRST, country NULLS FIRST, window_start LIMIT 5")))
def d01(spark, sf):
    return B.top_cities(W.city_metrics(enriched(spark, sf), *DAY))


@query("d02_top_countries", sql.chain(*sql.ENRICHED, ("m", COUNTRY_SQL), last=(
    "SELECT country, country_avg_aqi, unhealthy_percentage, hazardous_count FROM m "
    "ORDER BY country_avg_aqi DESC NULLS LAST, country NULLS FIRST, window_start LIMIT 5")))
def d02(spark, sf):
    return B.top_countries(W.country_trends(enriched(spark, sf), *DAY))


@query("d03_latest_urgent_alerts", sql.chain(*ALERTS, last=(
    "SELECT city, AQI, alert_priority, alert_message FROM alerts WHERE alert_priority <= 2 "
    f"ORDER BY ts DESC NULLS LAST, {sql.KEYS} LIMIT 5")))
def d03(spark, sf):
    return B.latest_alerts(_alerts(spark, sf), priority=2, ties=ORDER)


@query("d04_latest_alerts", sql.chain(*ALERTS, last=(
    f"SELECT city, AQI, health_risk_label FROM alerts ORDER BY ts DESC NULLS LAST, {sql.KEYS} LIMIT 5")))
def d04(spark, sf):
    return B.latest_alerts(_alerts(spark, sf), ties=ORDER)


@query("d05_top_city_stats", sql.chain(_STATS, last=(
    "SELECT * FROM stats ORDER BY avg_aqi DESC NULLS LAST, city NULLS FIRST, country NULLS FIRST LIMIT 10")))
def d05(spark, sf):
    return B.top_city_stats(_stats(spark, sf))


@query("d06_risk_distribution", sql.chain(*ALERTS, last=(
    "SELECT health_risk_label, n, "
    + sql.half_up("CAST(n AS DOUBLE) / (sum(n) OVER ()) * 100", 1)
    + " AS share_pct FROM (SELECT health_risk_label, count(*) AS n FROM alerts GROUP BY 1) AS c")))
def d06(spark, sf):
    return B.risk_distribution(_alerts(spark, sf))


@query("d07_aqi_histogram", sql.chain(
    _STATS, ("e", "SELECT min(avg_aqi) AS lo, max(avg_aqi) AS hi FROM stats"),
    ("counts", "SELECT least(CAST(floor((avg_aqi - lo) / (hi - lo) * 20) AS INTEGER), 19) AS bin, "
               "count(*) AS n FROM stats, e WHERE avg_aqi IS NOT NULL GROUP BY 1"),
    last=("SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * ((hi - lo) / 20), 6) AS bin_start, "
          "round(lo + (b.bin + 1) * ((hi - lo) / 20), 6) AS bin_end, COALESCE(n, 0) AS n "
          "FROM range(20) AS b(bin) CROSS JOIN e LEFT JOIN counts AS c ON b.bin = c.bin")))
def d07(spark, sf):
    return B.aqi_histogram(_stats(spark, sf)).withColumns({
        c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query("d08_summary", sql.chain(_STATS, last=(
    f"SELECT count(*) AS cities, {sql.stable('avg(avg_aqi)', 2)} AS avg_global_aqi, max(max_aqi) AS max_aqi, "
    "(SELECT count(*) FROM readings WHERE AQI > 200) AS critical_alerts FROM stats")))
def d08(spark, sf):
    return B.summary(_stats(spark, sf), _alerts(spark, sf))


# --- the same over stored results of streams ----------------------------------------------
@query("d06_from_stream", ORACLES["d06_risk_distribution"])
def d06_from_stream(spark, sf):
    return B.risk_distribution(_live(spark, sf, "d06-live", ["health_alerts"])["health_alerts"])


@query("d07_from_stream", ORACLES["d07_aqi_histogram"])
def d07_from_stream(spark, sf):
    return B.aqi_histogram(_stored_stats(spark, sf, "d07-live")).withColumns({
        c: F.round(c, 6) for c in ("bin_start", "bin_end")})


@query("d08_from_stream", ORACLES["d08_summary"])
def d08_from_stream(spark, sf):
    stored = _live(spark, sf, "d08-live", ["city_stats", "health_alerts"])
    return B.summary(stored["city_stats"].withColumn("avg_aqi", F.round("avg_aqi", 6)), stored["health_alerts"])
