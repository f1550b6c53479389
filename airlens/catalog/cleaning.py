"""Cleaning queries: gaps, duplicates, ranges, medians, sub-indices, and the whole chain."""

from pyspark.sql import functions as F

from airlens import config as C
from airlens.catalog import sql
from airlens.catalog.inputs import with_corrupt
from airlens.catalog.registry import query
from airlens.operators import clean, impute
from airlens.operators.validate import add_is_valid, error_codes
from airlens.plans.cleaning import clean_readings
from airlens.sources.readings import ORDER, city_lookup, country_lookup, readings


@query("c10_fill_country", sql.chain(("x", sql.filled_places("readings")), last=(
    f"SELECT {sql.KEYS}, country FROM x")))
def c10(spark, sf):
    return readings(spark, sf).transform(clean.fill_country, city_lookup(spark, sf)).select(*ORDER, "country")


@query("c11_fill_city", sql.chain(("x", sql.filled_places("readings")), last=(
    f"SELECT {sql.KEYS}, city, country FROM x")))
def c11(spark, sf):
    return (readings(spark, sf).transform(clean.fill_country, city_lookup(spark, sf))
            .transform(clean.fill_city, country_lookup(spark, sf)).select(*ORDER, "city", "country"))


@query("c12_fill_missing_date", sql.chain(("x", sql.filled_dates("readings")), last=(
    f"SELECT {sql.KEYS}, city, country, ts FROM x")))
def c12(spark, sf):
    return readings(spark, sf).transform(clean.fill_missing_date, ORDER).select(*ORDER, "city", "country", "ts")


@query("c12_fill_missing_date_hot_place", sql.chain(("one", "SELECT * REPLACE ('everywhere' AS city, CASE WHEN l_linenumber < 7 THEN 'X' END AS country) FROM readings"),
    ("x", sql.filled_dates("one")), last=f"SELECT {sql.KEYS}, country, ts FROM x"))
def c12_hot(spark, sf):
    """Two places, of which one holds most rows, ordered by a time and dealt to 24 ranges: dates carry across them."""
    rows = readings(spark, sf).withColumns({
        "city": F.lit("everywhere"), "country": F.when(F.col("l_linenumber") < 7, "X"), "seen": F.timestamp_micros(F.col("l_orderkey") * 40)})
    return rows.transform(clean.fill_missing_date, ["seen", *ORDER[1:]], partitions=24).select(*ORDER, "country", "ts")


@query("c13_dedup_daily", sql.chain(("x", sql.deduped("readings")), last=(
    f"SELECT {sql.KEYS}, country, city, CAST(event_date AS VARCHAR) AS event_date, AQI, pm25_ugm3 FROM x")))
def c13(spark, sf):
    return readings(spark, sf).transform(clean.dedup_daily, ORDER).select(
        *ORDER, "country", "city", "event_date", "AQI", "pm25_ugm3")


def _guard(name, guard, columns, mode):
    fixed = sql.guard_columns(clip=mode == "clip")
    shown = ", ".join(f"CAST({fixed[c]} AS DOUBLE) AS {c}" for c in columns)

    @query(f"{name}_{mode}", sql.chain(last=f"SELECT {sql.KEYS}, {shown} FROM readings"))
    def run(spark, sf):
        return readings(spark, sf).transform(guard, mode).select(*ORDER, *columns)


for _mode in ("nullify", "clip"):
    _guard("c15_guard_temp", clean.guard_temp, ["temp_c"], _mode)
    _guard("c16_guard_humidity", clean.guard_humidity, ["humidity_pct"], _mode)
    _guard("c17_guard_nonneg", clean.guard_nonneg, C.NON_NEGATIVE, _mode)


@query("c18_level_medians", sql.chain(last=" UNION ALL ".join(
    f"SELECT {i} AS level, {'country' if 'country' in level else 'NULL'} AS country, "
    f"{'city' if 'city' in level else 'NULL'} AS city, '{c}' AS var, quantile_disc({c}, 0.5) AS median "
    f"FROM readings{' WHERE ' + ' AND '.join(f'{k} IS NOT NULL' for k in level) if level else ''} "
    f"{'GROUP BY ' + ', '.join(level) if level else ''} HAVING count({c}) > 0"
    for i, level in enumerate(impute.LEVELS) for c in C.IMPUTED)))
def c18_medians(spark, sf):
    return impute.level_medians(readings(spark, sf)).select(
        "level", "scope.country", "scope.city", "var", "median")


@query("c18_impute_median", sql.chain(
    ("ranged", sql.guarded("readings")), ("whole", sql.imputed("ranged")),
    last=f"SELECT {sql.KEYS}, {', '.join(C.IMPUTED)} FROM whole"))
def c18(spark, sf):
    return (readings(spark, sf).transform(clean.guard_ranges).transform(impute.impute_median)
            .select(*ORDER, *C.IMPUTED))


@query("c19_sub_index", sql.chain(last=f"SELECT {sql.KEYS}, " + ", ".join(
    f"{sql.sub_index(c)} AS sub_{c}" for c in C.SUB_INDEX_SEGMENTS) + " FROM readings"))
def c19(spark, sf):
    return readings(spark, sf).select(*ORDER, *[
        impute.sub_index(c).alias(f"sub_{c}") for c in C.SUB_INDEX_SEGMENTS])


@query("c20_impute_aqi", sql.chain(("x", sql.indexed("readings")), last=(
    f"SELECT {sql.KEYS}, AQI FROM x")))
def c20(spark, sf):
    return readings(spark, sf).transform(impute.impute_aqi).select(*ORDER, "AQI")


_CLEAN_COLUMNS = [
    "country", "city", "event_date", *C.IMPUTED, "year", "month", "day", "day_of_week", "season",
    "pm_ratio", "aqi_category", *[f"aqi_bucket_{C.short(p)}" for p in C.POLLUTANTS],
    *[f"{C.short(p)}_exceeds_who" for p in C.POLLUTANTS], "who_compliant_all", "is_valid"]


@query("clean_readings", sql.chain(
    *[(n, s) if n != "enriched" else (n, s.replace(sql.HEMISPHERE, "CASE WHEN city IN ('Sydney', 'São Paulo') THEN 'S' ELSE 'N' END"))
      for n, s in sql.CLEANED],
    ("flagged", sql.flagged("enriched")),
    last=(f"SELECT {sql.KEYS}, ts, AQI, error_codes, " + ", ".join(
        f"CAST({c} AS VARCHAR) AS {c}" if c == "event_date" else c for c in _CLEAN_COLUMNS)
        + " FROM flagged")))
def cleaned(spark, sf):
    df = clean_readings(readings(spark, sf), ORDER, city_lookup(spark, sf), country_lookup(spark, sf))
    df = df.transform(with_corrupt).transform(add_is_valid)
    return df.select(*ORDER, "ts", "AQI",
                     F.array_join(error_codes(), ",").alias("error_codes"), *_CLEAN_COLUMNS)
