"""Validity: one list of checks gives the flag, the error codes and the split."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from airlens import config as C
from airlens.functions import is_number


def temp_ok(country: Column, temp: Column,
            bounds: Mapping[str, tuple[float, float]] = C.VALID_TEMP_BOUNDS) -> Column:
    """Temperature plausible for its country. Unknown country: false; missing country: NULL."""
    checks = None
    for name, (low, high) in bounds.items():
        check = (country == name) & temp.between(low, high)
        checks = check if checks is None else checks | check
    return checks


def aqi_ok(aqi: Column, bounds: tuple[float, float] = C.VALID_AQI_BOUNDS) -> Column:
    return is_number(aqi) & aqi.between(*bounds)


def _filled(name: str) -> Column:
    return F.col(name).isNotNull() & (F.length(F.trim(F.col(name))) > 0)


def checks() -> list[tuple[str, Column]]:
    """(error code, condition that must hold), in reporting order."""
    low, high = C.HUMIDITY_BOUNDS
    number = lambda c: is_number(F.col(c))
    return [
        ("CITY_EMPTY", _filled("city")),
        ("COUNTRY_EMPTY", _filled("country")),
        ("TEMP_OUT_OF_RANGE_OR_UNKNOWN_COUNTRY",
         number("temp_c") & temp_ok(F.col("country"), F.col("temp_c"))),
        ("HUMIDITY_INVALID", number("humidity_pct") & F.col("humidity_pct").between(low, high)),
        ("WIND_INVALID", number("wind_ms") & (F.col("wind_ms") >= 0)),
        *[(f"{p.upper()}_INVALID", number(p) & (F.col(p) >= 0)) for p in C.POLLUTANTS],
        ("AQI_INVALID", aqi_ok(F.col("AQI"))),
        ("CSV_CORRUPT", F.col(C.CORRUPT).isNull() | (F.col(C.CORRUPT) == "")),
    ]


def add_is_valid(df: DataFrame) -> DataFrame:
    """``is_valid``: every check holds. Never NULL: a check that is NULL (temperature of a missing
    country) comes with one that is false."""
    every = None
    for _, condition in checks():
        every = condition if every is None else every & condition
    return df.withColumn("is_valid", every)


def error_codes() -> Column:
    """Codes of the checks that fail, in order. A check that is NULL raises none."""
    marks = [F.when(~condition, F.lit(code)) for code, condition in checks()]
    text = F.concat_ws(",", *marks)      # leaves NULLs out, and unlike a filter over an array compiles
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))


def error_message() -> Column:
    """The reading in one line of text; unknown parts are left out."""
    shown = {"country": "country", "city": "city", "temp_c": "temp_c",
             "humidity": "humidity_pct", "wind_ms": "wind_ms", "AQI": "AQI"}
    parts = [F.concat(F.lit(f"{label}="), F.col(c).cast("string")) for label, c in shown.items()]
    pollutants = F.concat_ws(",", *[F.col(p).cast("string") for p in C.POLLUTANTS])
    return F.concat_ws(" | ", F.lit("failed validation"), *parts,
                       F.concat(F.lit("pollutants="), pollutants))


def label_errors(df: DataFrame, ingest_ts: bool = True) -> DataFrame:
    """``error_codes``, ``error_code`` (the first), ``error_message`` and ``ingest_ts``."""
    df = df.withColumn("error_codes", error_codes())
    df = df.withColumns({
        "error_code": F.try_element_at("error_codes", F.lit(1)),
        "error_message": error_message(),
    })
    if ingest_ts:
        clock = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        df = df.withColumn("ingest_ts", clock)
    return df


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, invalid, invalid with labels). All three read ``df``: pass a written table."""
    flagged = add_is_valid(df)
    valid = flagged.filter("is_valid").drop("is_valid")
    invalid = flagged.filter(~F.col("is_valid"))
    return valid, invalid, label_errors(invalid)


def error_histogram(labeled: DataFrame) -> DataFrame:
    """Number of readings per first error, most frequent first."""
    return labeled.groupBy("error_code").count().orderBy(F.desc("count"), "error_code")
