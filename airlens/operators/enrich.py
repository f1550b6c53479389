"""Calendar, ratios, categories and guideline flags."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from airlens import config as C
from airlens.functions import bucketize, first_match
from airlens.operators.clean import with_event_date


def add_calendar(df: DataFrame) -> DataFrame:
    """``year, month, day`` and ``day_of_week`` ("Mon") of ``event_date``."""
    day = F.col("event_date")
    return df.withColumns({
        "year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day),
        "day_of_week": F.date_format(day, "E"),
    })


def hemisphere(city: Column, southern: Sequence[str] = tuple(C.SOUTHERN_CITIES)) -> Column:
    return F.when(city.isin(*southern), "S").otherwise("N")


def season(day: Column, hemisphere: Column) -> Column:
    """Season of a date. Without a date the last season of the year is reported."""
    month = F.month(day)
    by_month = {
        side: first_match([(month.isin(*months), F.lit(name))
                           for months, name in zip(C.SEASON_MONTHS, names)], F.lit(names[-1]))
        for side, names in C.SEASONS_BY_HEMISPHERE.items()
    }
    return F.when(hemisphere == "N", by_month["N"]).otherwise(by_month["S"])


def add_season(df: DataFrame, southern: Sequence[str] = tuple(C.SOUTHERN_CITIES)) -> DataFrame:
    side = hemisphere(F.col("city"), southern)
    return df.withColumns({"hemisphere": side, "season": season(F.col("event_date"), side)})


def pm_ratio(fine: str = "pm25_ugm3", coarse: str = "pm10_ugm3") -> Column:
    """Fine to coarse particles; NULL unless the coarse value is positive."""
    return F.when(F.col(coarse) > 0, F.col(fine) / F.col(coarse))


def aqi_category(aqi: str = "AQI") -> Column:
    return bucketize(F.col(aqi), C.AQI_CUTS, C.QUALITY_LABELS)


def add_buckets(df: DataFrame, cuts: Mapping[str, Sequence[float]] = C.BUCKET_CUTS) -> DataFrame:
    """``aqi_bucket_<pollutant>`` for each pollutant."""
    return df.withColumns({
        f"aqi_bucket_{C.short(p)}": bucketize(F.col(p), limits, C.QUALITY_LABELS)
        for p, limits in cuts.items()
    })


def add_who_flags(df: DataFrame, limits: Mapping[str, float] = C.WHO_LIMITS) -> DataFrame:
    """``<pollutant>_exceeds_who`` and ``who_compliant_all``. An unknown value counts as neither
    exceeding nor compliant: "No" in both."""
    within = reduce(Column.__and__, [F.col(p) <= limit for p, limit in limits.items()])
    return df.withColumns({
        **{f"{C.short(p)}_exceeds_who": F.when(F.col(p) > limit, "Yes").otherwise("No")
           for p, limit in limits.items()},
        "who_compliant_all": F.when(within, "Yes").otherwise("No"),
    })


def enrich(df: DataFrame, buckets: bool = True, who_flags: bool = True,
           southern: Sequence[str] = tuple(C.SOUTHERN_CITIES)) -> DataFrame:
    """Everything above on a cleaned reading."""
    df = df.transform(with_event_date).transform(add_calendar).transform(add_season, southern)
    df = df.withColumns({"pm_ratio": pm_ratio(), "aqi_category": aqi_category()})
    if buckets:
        df = df.transform(add_buckets)
    return df.transform(add_who_flags) if who_flags else df
