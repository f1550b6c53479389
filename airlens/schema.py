"""Explicit schemas. No reader in this package infers one."""

from pyspark.sql import types as T

from airlens import config as C

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()


def _struct(*groups) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for names, kind in groups for name in names])


_PLACE_HEADERS = ["Date", "City", "Country"]
_NUMBER_HEADERS = [c for c in C.RAW_COLUMNS if c not in _PLACE_HEADERS]

#: A message or CSV line as it arrives: 13 named strings.
RAW = _struct((C.RAW_COLUMNS, _S))

#: The same record with numbers.
TYPED = _struct((_PLACE_HEADERS, _S), (_NUMBER_HEADERS, _D))

#: ``TYPED`` plus the column in which Spark keeps a line it could not parse.
BATCH = _struct((_PLACE_HEADERS, _S), (_NUMBER_HEADERS, _D), ([C.CORRUPT], _S))

#: ``RAW`` plus the corrupt-line column, for sources whose numbers are quoted.
RAW_BATCH = _struct((C.RAW_COLUMNS, _S), ([C.CORRUPT], _S))

#: A clean reading, 35 fields; ``event_date`` is text at the JSON edge.
CLEAN = _struct(
    (["ts"], T.TimestampType()),
    (["city", "country"], _S),
    (["AQI", "co_ppm", "humidity_pct", "no2_ppb", "o3_ppb", "pm10_ugm3", "pm25_ugm3",
      "so2_ppb", "temp_c", "wind_ms"], _D),
    (["event_date"], _S),
    (["year", "month", "day"], _I),
    (["day_of_week", "hemisphere", "season"], _S),
    (["pm_ratio"], _D),
    (["aqi_category"], _S),
    ([f"aqi_bucket_{C.short(p)}" for p in C.POLLUTANTS], _S),
    ([f"{C.short(p)}_exceeds_who" for p in C.POLLUTANTS], _S),
    (["who_compliant_all"], _S),
)
