"""Window aggregates as tables and as streams, streaming deduplication, stream sinks.

Streams here read files that Spark writes from the tables first, run with the ``availableNow``
trigger until the input is used up, and return what their sink holds.
"""

from pyspark.sql import functions as F

from airlens import config as C, schema as S
from airlens.catalog import sql
from airlens.catalog.inputs import enriched, messages, raw_sql
from airlens.catalog.registry import query
from airlens.catalog.rows import ALERTS
from airlens.operators import clean, dashboard as B, risk as R, windows as W
from airlens.shared import discard, materialized, scratch_path, write_json
from airlens.sources import stream_json
from airlens.sources.messages import decode_raw, decode_typed
from airlens.sources.readings import ORDER, places, readings, table
from airlens.streaming import sinks
from airlens.streaming.dedup import dedup_daily_stream
from airlens.streaming.live import results, start_live

#: readings are daily, so the reports use days where the live feed uses minutes
DAY = ("2 days", "1 day", "2 days")
ALL = {"availableNow": True}
#: files a batch may have where all there are belong to one: rows have no order in time, so a second batch would find windows closed
ONE_BATCH = 1_000_000


def _windows(width: int, slide: int) -> str:
    """Readings times the windows (in days) they fall into."""
    return f"""(SELECT s.*, CAST(w.d AS TIMESTAMP) AS window_start,
  CAST(w.d AS TIMESTAMP) + INTERVAL {width} DAY AS window_end
FROM (SELECT *, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS n FROM enriched WHERE ts IS NOT NULL) AS s,
  LATERAL (SELECT DATE '1970-01-01' + CAST((n // {slide} - i) * {slide} AS INTEGER) AS d
           FROM range({-(-width // slide)}) AS r(i) WHERE n < (n // {slide} - i) * {slide} + {width}) AS w)"""


CITY_SQL = f"""SELECT window_start, window_end, city, country, {sql.stable('avg(AQI)', 2)} AS avg_aqi,
  max(AQI) AS max_aqi, min(AQI) AS min_aqi, {sql.stable('avg(pm25_ugm3)', 2)} AS avg_pm25,
  {sql.stable('avg(pm10_ugm3)', 2)} AS avg_pm10, {sql.stable('avg(temp_c)', 1)} AS avg_temp,
  {sql.stable('avg(humidity_pct)', 1)} AS avg_humidity, count(*) AS measurement_count,
  count(CASE WHEN who_compliant_all = 'No' THEN 1 END) AS who_violations
FROM {_windows(2, 1)} AS x GROUP BY window_start, window_end, city, country"""
COUNTRY_SQL = f"""SELECT *, {sql.half_up('CAST(unhealthy_count AS DOUBLE) / total_readings * 100', 2)} AS unhealthy_percentage
FROM (SELECT window_start, window_end, country, {sql.stable('avg(AQI)', 2)} AS country_avg_aqi,
  {sql.stable('stddev_samp(AQI)', 2)} AS aqi_stddev, {sql.half_up('quantile_disc(AQI, 0.5)', 2)} AS median_aqi,
  count(CASE WHEN AQI > 200 THEN 1 END) AS hazardous_count,
  count(CASE WHEN AQI > 150 THEN 1 END) AS unhealthy_count, count(*) AS total_readings
  FROM {_windows(2, 1)} AS x GROUP BY window_start, window_end, country) AS t"""


def _corr(x: str) -> str:
    return sql.stable(f"(covar_pop({x}, AQI) / nullif(stddev_pop(CASE WHEN AQI IS NOT NULL THEN {x} END) "
                      f"* stddev_pop(CASE WHEN {x} IS NOT NULL THEN AQI END), 0))", 3)


CORR_SQL = f"""SELECT window_start, window_end, {_corr('pm25_ugm3')} AS pm25_aqi_corr,
  {_corr('pm10_ugm3')} AS pm10_aqi_corr, {_corr('no2_ppb')} AS no2_aqi_corr,
  {sql.stable('avg(pm25_ugm3)', 2)} AS global_avg_pm25, {sql.stable('avg(pm10_ugm3)', 2)} AS global_avg_pm10,
  {sql.stable('avg(AQI)', 2)} AS global_avg_aqi
FROM {_windows(5, 2)} AS x GROUP BY window_start, window_end"""
CORR = ("5 days", "2 days", "2 days")


@query("t5_03_city_metrics", sql.chain(*sql.ENRICHED, last=CITY_SQL))
def t5_03(spark, sf):
    return W.city_metrics(enriched(spark, sf), *DAY)


@query("t5_04_country_trends", sql.chain(*sql.ENRICHED, last=COUNTRY_SQL))
def t5_04(spark, sf):
    return W.country_trends(enriched(spark, sf), *DAY)


@query("t5_05_pollutant_correlations", sql.chain(*sql.ENRICHED, last=CORR_SQL))
def t5_05(spark, sf):
    return W.pollutant_correlations(enriched(spark, sf), *CORR)


@query("t5_06_city_stats", sql.chain(last=(
    "SELECT city, country, round(avg(AQI), 6) AS avg_aqi, max(AQI) AS max_aqi, count(*) AS count "
    "FROM readings GROUP BY city, country")))
def t5_06(spark, sf):
    return enriched(spark, sf).transform(W.city_stats).withColumn("avg_aqi", F.round("avg_aqi", 6))


# --- streams -----------------------------------------------------------------------
def _clean_stream(spark, sf, name):
    """Clean readings as a JSON file stream of one batch."""
    folder = scratch_path(spark, f"{name}-input")
    write_json(enriched(spark, sf).select(*S.CLEAN.names), folder)
    return stream_json(spark, folder, max_files_per_trigger=ONE_BATCH)


def _run(started):
    started.awaitTermination()
    if started.exception():
        raise started.exception()


_CLEAN = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" if c == "event_date" else c for c in S.CLEAN.names)


@query("t5_01_k07_stream_json_to_parquet", sql.chain(*sql.ENRICHED, last=f"SELECT {_CLEAN} FROM enriched"))
def t5_01(spark, sf):
    out = scratch_path(spark, "t5-01")
    _run(sinks.to_parquet(_clean_stream(spark, sf, "t5-01"), f"{out}/data", f"{out}/checkpoint", ALL))
    return spark.read.schema(S.CLEAN).parquet(f"{out}/data")


def _snapshot(name, aggregate, window, mode):
    def run(spark, sf):
        out = scratch_path(spark, name)
        result = aggregate(_clean_stream(spark, sf, name), *window)
        _run(sinks.to_snapshot(result, f"{out}/data", f"{out}/checkpoint", mode, ALL))
        return sinks.read_snapshot(spark, f"{out}/data", mode)
    return run


query("k06_city_metrics_stream", sql.chain(*sql.ENRICHED, last=CITY_SQL))(
    _snapshot("k06-city", W.city_metrics, DAY, "complete"))
query("k06_country_trends_stream", sql.chain(*sql.ENRICHED, last=COUNTRY_SQL))(
    _snapshot("k06-country", W.country_trends, DAY, "complete"))
# Append output: the watermark closes all windows but those that end within two days of the newest reading.
query("t5_02_city_metrics_append", sql.chain(*sql.ENRICHED, ("m", CITY_SQL), last=(
    "SELECT * FROM m WHERE window_end <= (SELECT max(ts) - INTERVAL 2 DAY FROM readings)")))(
    _snapshot("t5-02-city", W.city_metrics, DAY, "append"))


@query("t5_20_k07_alert_log_stream", sql.chain(*sql.ENRICHED, ("alerts", "SELECT *, "
    "CASE WHEN AQI > 300 THEN 1 WHEN AQI > 200 AND who_compliant_all = 'No' THEN 2 "
    "WHEN AQI > 150 AND pm25_exceeds_who = 'Yes' THEN 3 WHEN AQI > 100 THEN 4 ELSE 5 END AS alert_priority "
    "FROM enriched"), last="SELECT ts, city, AQI, alert_priority FROM alerts WHERE alert_priority <= 3"))
def alert_log(spark, sf):
    out = scratch_path(spark, "alert-log")
    alerts = _clean_stream(spark, sf, "alert-log").transform(R.alerts).transform(R.urgent_alerts)
    _run(sinks.to_parquet(alerts, f"{out}/data", f"{out}/checkpoint", ALL))
    return spark.read.parquet(f"{out}/data").select("ts", "city", "AQI", "alert_priority")


@query("c14_dedup_stream", "SELECT DISTINCT event_type AS city, CAST(user_id AS VARCHAR) AS country, "
                           "CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date FROM events")
def c14(spark, sf):
    folder, out = scratch_path(spark, "c14-input"), scratch_path(spark, "c14")
    events = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("city"),
        F.col("user_id").cast("string").alias("country"), F.col("value").alias("AQI"))
    write_json(events, folder)
    stream = stream_json(spark, folder, events.schema, max_files_per_trigger=ONE_BATCH)
    _run(sinks.to_parquet(dedup_daily_stream(stream), f"{out}/data", f"{out}/checkpoint", ALL))
    return spark.read.parquet(f"{out}/data").select("city", "country", "event_date")


# --- several batches, rows that come late -----------------------------------------------
#: the turn in which a reading arrives: by date, but every seventh line of an order one turn late
_TURN = ("CASE WHEN ts IS NULL OR ts < TIMESTAMP '1997-06-01 00:00:00' THEN 0 WHEN ts < TIMESTAMP '1999-09-01 00:00:00' THEN 1 ELSE 2 END "
         "+ CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END")
#: the same of events
_EVENT_TURN = ("CASE WHEN ts < TIMESTAMP '2024-01-08 00:00:00' THEN 0 WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 1 "
               "WHEN ts < TIMESTAMP '2024-01-24 00:00:00' THEN 2 ELSE 3 END + CASE WHEN user_id % 10 = 3 THEN 1 ELSE 0 END")


def _in_turns(spark, name, rows, turn, turns, start, before=None):
    """Rows reach a stream turn by turn: each turn's files are there before ``start(stream)`` goes on from its checkpoint, and
    it has used them up, and closed what the watermark closes, before the next ones come. ``before(turn)`` comes first."""
    folder = scratch_path(spark, f"{name}-input")
    staged = materialized(rows.withColumn("_turn", F.expr(turn)), f"{folder}/staged")
    shape = staged.drop("_turn").schema
    for number in range(turns):
        if before:
            before(number)
        write_json(staged.where(F.col("_turn") == number).drop("_turn"), f"{folder}/in-{number}")
        _run(start(stream_json(spark, f"{folder}/in-*", shape, max_files_per_trigger=ONE_BATCH)))
    discard(spark, folder)


def _dealt(source, turn, late):
    """Steps that give each row the watermark it met: what came before its turn, less the allowed delay."""
    return [("dealt", f"SELECT *, {turn} AS turn FROM {source}"),
            ("seen", f"SELECT turn, max(max(ts)) OVER (ORDER BY turn) - INTERVAL {late} DAY AS mark FROM dealt GROUP BY turn"),
            ("met", "SELECT d.*, mark FROM dealt d LEFT JOIN seen s ON s.turn = d.turn - 1")]


def _on_time(sql_text):
    """A windowed aggregate of the windows that the watermark had not closed when their rows came."""
    return sql_text.replace("FROM enriched WHERE", "FROM met WHERE").replace(
        ") AS x GROUP BY", ") AS x WHERE mark IS NULL OR window_end > mark GROUP BY")


_MET, _CLOSED = [*sql.ENRICHED, *_dealt("enriched", _TURN, 2)], "SELECT * FROM m WHERE window_end <= (SELECT max(mark) FROM seen)"
_CITY_KEYS = ("window_start", "city", "country")


def _late_snapshot(name, aggregate, window, mode, keys=()):
    def run(spark, sf):
        out = scratch_path(spark, name)
        _in_turns(spark, name, enriched(spark, sf).select(*S.CLEAN.names, "l_linenumber"), _TURN, 4, lambda stream: sinks.to_snapshot(
            aggregate(stream, *window), f"{out}/data", f"{out}/checkpoint", mode, ALL, merge_every=2, keys=keys))
        return sinks.read_snapshot(spark, f"{out}/data", mode, keys)
    return run


# Late rows are in no window that had closed before their turn; append output has the windows closed in the end.
query("t5_02_city_metrics_late", sql.chain(*_MET, ("m", _on_time(CITY_SQL)), last=_CLOSED))(
    _late_snapshot("t5-02-late", W.city_metrics, DAY, "append"))
query("t5_05_correlations_stream", sql.chain(*_MET, ("m", _on_time(CORR_SQL)), last=_CLOSED))(
    _late_snapshot("t5-05-late", W.pollutant_correlations, CORR, "append"))
# Update output has every window, as of the last batch that changed it; versions are merged while it runs.
query("k06_update_stream", sql.chain(*_MET, last=_on_time(CITY_SQL)))(
    _late_snapshot("k06-update", W.city_metrics, DAY, "update", _CITY_KEYS))


@query("c14_dedup_stream_late", "WITH " + ", ".join(f"{name} AS ({body})" for name, body in _dealt(
    "(SELECT user_id, event_type, date_trunc('second', ts) AS ts FROM events)", _EVENT_TURN, 1)) +
    " SELECT DISTINCT event_type AS city, CAST(user_id AS VARCHAR) AS country, CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date "
    "FROM met WHERE mark IS NULL OR ts > mark")
def c14_late(spark, sf):
    """Five turns, state that expires, and copies that come a turn late: those behind the watermark are dropped."""
    out = scratch_path(spark, "c14-late")
    events = table(spark, sf, "events").select(
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"), F.col("event_type").alias("city"), "user_id",
        F.col("user_id").cast("string").alias("country"), F.col("value").alias("AQI"))
    _in_turns(spark, "c14-late", events, _EVENT_TURN, 5, lambda stream: sinks.to_parquet(
        dedup_daily_stream(stream), f"{out}/data", f"{out}/checkpoint", ALL))
    return spark.read.parquet(f"{out}/data").select("city", "country", "event_date")


_GROWN = [("dealt", f"SELECT *, {_TURN} AS turn FROM readings"),
          ("known", "SELECT s_name AS p_city, s_suppkey, CASE n_regionkey WHEN 0 THEN 'USA' WHEN 1 THEN 'France' WHEN 2 THEN 'India' "
                    "WHEN 3 THEN 'Brazil' ELSE 'Egypt' END AS p_country FROM supplier JOIN nation ON s_nationkey = n_nationkey"),
          ("placed", "SELECT d.* REPLACE (coalesce(d.country, p_country) AS country) FROM dealt d "
                     "LEFT JOIN known ON p_city = d.city AND s_suppkey % 4 <= turn"),
          ("bound", f"SELECT *, CASE WHEN country IS NULL OR country = 'Brazil' AND turn = 0 THEN {C.GUARD_TEMP_FALLBACK[0]} ELSE -20 - 5 * turn - length(country) END AS low, "
                    f"CASE WHEN country IS NULL OR country = 'Brazil' AND turn = 0 THEN {C.GUARD_TEMP_FALLBACK[1]} ELSE 50 + 5 * turn - length(country) END AS high FROM placed")]


@query("c15_c10_lookups_stream", sql.chain(*_GROWN, last=(
    f"SELECT {sql.KEYS}, city, country, CASE WHEN temp_c < low OR temp_c > high THEN NULL ELSE temp_c END AS temp_c FROM bound")))
def lookups_stream(spark, sf):
    """Cities and temperature bounds as tables that are replaced before each turn: a reading meets those of its own turn."""
    out = scratch_path(spark, "lookups-stream")
    cities = places(spark, sf).groupBy("city").agg(F.min("country").alias("country"), F.min("s_suppkey").alias("k"))
    limit = lambda base, n: (F.lit(base + n) - F.length("country")).cast("double")

    def replace(number):
        cities.where(F.col("k") % 4 <= number).drop("k").write.parquet(f"{out}/cities-{number}")
        bounds = cities.select("country").distinct().where((F.col("country") != "Brazil") | F.lit(number > 0))
        bounds.select("country", limit(-20, -5 * number), limit(50, 5 * number)).toDF("country", "low", "high").write.parquet(f"{out}/bounds-{number}")
        turn.append(number)

    def start(stream):
        now = lambda name: spark.read.parquet(f"{out}/{name}-{turn[-1]}")
        cleaned = stream.transform(clean.fill_country, now("cities")).transform(clean.guard_temp, bounds=now("bounds"))
        return sinks.to_parquet(cleaned, f"{out}/data", f"{out}/checkpoint", ALL)

    turn = []
    rows = readings(spark, sf).select(*ORDER, "ts", "city", "country", "temp_c")
    _in_turns(spark, "lookups-stream", rows, _TURN, 4, start, replace)
    return spark.read.parquet(f"{out}/data").select(*ORDER, "city", "country", "temp_c")


# --- message sinks ------------------------------------------------------------------
def _message_stream(spark, sf, name):
    folder = scratch_path(spark, f"{name}-input")
    sent = messages(spark, sf).select("value")
    sent.write.parquet(folder)
    return spark.readStream.schema(sent.schema).parquet(folder)


_RAW = [("raw", raw_sql("l_partkey % 50 = 7"))]
@query("k02_raw_csv_stream", sql.chain(*_RAW, last="SELECT " + ", ".join(
    f"""nullif(trim("{c}"), '') AS "{c}\"""" for c in C.RAW_COLUMNS) + " FROM raw"))
def k02(spark, sf):
    out = scratch_path(spark, "k02")
    _run(sinks.to_raw_csv(decode_raw(_message_stream(spark, sf, "k02")), f"{out}/data",
                          f"{out}/checkpoint", ALL))
    rows = spark.read.schema(S.RAW).option("header", True).csv(f"{out}/data")
    return rows.select(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) for c in C.RAW_COLUMNS])


@query("k03_typed_json_stream", sql.chain(*_RAW, last='SELECT "Date", "City", "Country", ' + ", ".join(
    f'TRY_CAST("{c}" AS DOUBLE) AS "{c}"' for c in C.RAW_COLUMNS[3:]) + " FROM raw"))
def k03(spark, sf):
    out = scratch_path(spark, "k03")
    _run(sinks.to_json(decode_typed(_message_stream(spark, sf, "k03")), f"{out}/data",
                       f"{out}/checkpoint", ALL))
    return spark.read.schema(S.TYPED).json(f"{out}/data")


# --- the dashboard over stored results -------------------------------------------------
def _live(spark, sf, name, names=None, spans=None):
    base = scratch_path(spark, name)
    started = start_live(_clean_stream(spark, sf, name), base, ALL, preview=False, names=names, spans=spans)
    for one in started.values():
        _run(one)
    return results(spark, base, names)


_CLOSED_WINDOWS = "WHERE window_end <= (SELECT max(ts) - INTERVAL 2 DAY FROM readings)"


@query("d01_from_stream", sql.chain(*sql.ENRICHED, ("m", CITY_SQL), last=(
    f"SELECT city, country, avg_aqi, max_aqi, who_violations, measurement_count FROM m {_CLOSED_WINDOWS} "
    "ORDER BY avg_aqi DESC NULLS LAST, city NULLS FIRST, country NULLS FIRST, window_start LIMIT 5")))
def d01_from_stream(spark, sf):
    return B.top_cities(_live(spark, sf, "d01-live", ["city_metrics"], {"city_metrics": DAY})["city_metrics"])


@query("d02_from_stream", sql.chain(*sql.ENRICHED, ("m", COUNTRY_SQL), last=(
    f"SELECT country, country_avg_aqi, unhealthy_percentage, hazardous_count FROM m {_CLOSED_WINDOWS} "
    "ORDER BY country_avg_aqi DESC NULLS LAST, country NULLS FIRST, window_start LIMIT 5")))
def d02_from_stream(spark, sf):
    return B.top_countries(_live(spark, sf, "d02-live", ["country_trends"], {"country_trends": DAY})["country_trends"])


@query("d03_from_stream", sql.chain(*ALERTS, last=(
    "SELECT city, country, AQI, alert_priority, alert_message FROM alerts WHERE alert_priority <= 3")))
def d03_from_stream(spark, sf):
    """The whole alert log, as it is stored."""
    return _live(spark, sf, "d03-live", ["alert_log", "alerts"])["alerts"].select(
        "city", "country", "AQI", "alert_priority", "alert_message")


@query("d03_latest_from_stream", sql.chain(*ALERTS, last=(
    "SELECT city, AQI, alert_priority, alert_message FROM alerts WHERE alert_priority <= 2 ORDER BY ts DESC NULLS LAST, "
    "city NULLS FIRST, AQI NULLS FIRST, alert_priority, alert_message NULLS FIRST LIMIT 5")))
def d03_latest_from_stream(spark, sf):
    """The newest five stored alerts of priority 1 and 2, by the readings' own clock."""
    stored = _live(spark, sf, "d03-latest-live", ["health_alerts"])["health_alerts"]
    return B.latest_alerts(stored, priority=2, clock="ts", ties=("city", "AQI", "alert_priority", "alert_message"))


@query("d04_from_stream", sql.chain(*ALERTS, last=(
    "SELECT city, AQI, health_risk_label FROM alerts ORDER BY ts DESC NULLS LAST, city NULLS FIRST, AQI NULLS FIRST, "
    "health_risk_label LIMIT 5")))
def d04_from_stream(spark, sf):
    stored = _live(spark, sf, "d04-live", ["health_alerts"])["health_alerts"]
    return B.latest_alerts(stored, clock="ts", ties=("city", "AQI", "health_risk_label"))


def _stored_stats(spark, sf, name):
    return _live(spark, sf, name, ["city_stats"])["city_stats"].withColumn("avg_aqi", F.round("avg_aqi", 6))


@query("d05_from_stream", sql.chain(*sql.ENRICHED, last=(
    "SELECT city, country, round(avg(AQI), 6) AS avg_aqi, max(AQI) AS max_aqi, count(*) AS count FROM enriched GROUP BY city, country "
    "ORDER BY avg_aqi DESC NULLS LAST, city NULLS FIRST, country NULLS FIRST LIMIT 10")))
def d05_from_stream(spark, sf):
    return B.top_city_stats(_stored_stats(spark, sf, "d05-live"))
