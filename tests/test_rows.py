"""Thresholds of the row rules: below, at, above, unknown."""

import pytest
from pyspark.sql import functions as F

from airlens import config as C
from airlens.operators import enrich as E, risk as R, validate as V
from tests.helpers import at, many, tuples

NONE = dict.fromkeys(C.POLLUTANTS)


def readings(spark, *rows, **fixed):
    """Rows of measurements over a default reading."""
    base = {"city": "Paris", "country": "France", "season": "Spring", "who_compliant_all": "No",
            "pm25_exceeds_who": "Yes", C.CORRUPT: None, **{m: 1.0 for m in C.MEASUREMENTS}, **fixed}
    kinds = {k: "string" if k not in C.MEASUREMENTS else "double" for k in base}
    data = [tuple({**base, **r}[k] for k in base) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{k} {t}" for k, t in kinds.items())).coalesce(1)


def column(df, name):
    return [r[name] for r in df.collect()]


@pytest.mark.parametrize("pollutant", C.POLLUTANTS)
def test_who_flags(spark, pollutant):
    limit = float(C.WHO_LIMITS[pollutant])
    df = readings(spark, {pollutant: limit - 0.01}, {pollutant: limit}, {pollutant: limit + 0.01}, {pollutant: None})
    df = E.add_who_flags(df)
    assert column(df, f"{C.short(pollutant)}_exceeds_who") == ["No", "No", "Yes", "No"]
    assert column(df, "who_compliant_all") == ["Yes", "Yes", "No", "No"]


def test_seasons(spark):
    months = [*range(1, 13)]
    for side, names in C.SEASONS_BY_HEMISPHERE.items():
        got = many(spark, lambda v: E.season(v.cast("date"), F.lit(side)), "string",
                   [f"2024-{m:02d}-15" for m in months] + [None])
        want = [names[0]] * 2 + [n for n in names[1:] for _ in range(3)] + [names[0], names[3]]
        assert got == want


def test_enrich_calendar_and_ratio(spark):
    df = readings(spark, {"city": "Sydney", "pm25_ugm3": 3.0, "pm10_ugm3": 4.0}, {"pm10_ugm3": 0.0}, {"pm25_ugm3": None})
    df = df.drop("season", "who_compliant_all", "pm25_exceeds_who").withColumn("ts", F.lit("2024-02-29 23:59:59").cast("timestamp"))
    rows = E.enrich(df).collect()
    assert [r["pm_ratio"] for r in rows] == [0.75, None, None]
    first = rows[0]
    assert (first["year"], first["month"], first["day"], first["day_of_week"]) == (2024, 2, 29, "Thu")
    assert (first["hemisphere"], first["season"]) == ("S", "Summer") and rows[1]["hemisphere"] == "N"
    assert "aqi_bucket_co" not in E.enrich(df, buckets=False, who_flags=False).columns


def test_given_event_date_is_kept(spark):
    df = readings(spark, {}).withColumns({"ts": F.lit("2024-02-01").cast("timestamp"),
                                          "event_date": F.lit("2020-01-01").cast("date")})
    assert E.enrich(df.drop("season")).first()["year"] == 2020


def test_health_risk(spark):
    values = [50.0, 50.1, 100.0, 100.1, 150.0, 150.1, 200.0, 200.1, 300.0, 300.1, None]
    df = R.add_health_risk(readings(spark, *[{"AQI": v} for v in values]))
    assert column(df, "health_risk_score") == [1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6]
    assert column(df, "health_risk_label")[-2:] == ["Hazardous", "Hazardous"]
    assert column(df, "health_risk_label")[3] == "Unhealthy for Sensitive"


def test_weather(spark):
    calm = {"wind_ms": 1.0, "humidity_pct": 50.0, "temp_c": 20.0, "AQI": 100.0}
    cases = [({}, 100.0, "Normal"), ({"wind_ms": 5.0}, 100.0, "Normal"), ({"wind_ms": 5.1}, 70.0, "Normal"),
             ({"wind_ms": 8.1}, 70.0, "Windy"), ({"humidity_pct": 70.0}, 100.0, "Normal"),
             ({"humidity_pct": 80.1}, 120.0, "Humid"), ({"temp_c": 35.1}, 110.0, "Hot"),
             ({"temp_c": 4.9}, 110.0, "Cold"), ({"temp_c": 10.0}, 100.0, "Normal"),
             ({"wind_ms": None, "humidity_pct": None, "temp_c": None}, 100.0, "Normal"), ({"AQI": None}, None, "Normal")]
    df = R.add_weather_impact(readings(spark, *[{**calm, **c} for c, *_ in cases]))
    assert column(df, "adjusted_aqi") == [a for _, a, _ in cases]
    assert column(df, "weather_condition") == [w for *_, w in cases]


def test_primary_pollutant(spark):
    four = lambda a, b, c, d: {"pm25_ugm3": a, "pm10_ugm3": b, "no2_ppb": c, "so2_ppb": d}
    cases = [(four(9.0, 1.0, 1.0, 1.0), "PM2.5"), (four(1.0, 9.0, 1.0, 1.0), "PM10"), (four(9.0, 9.0, 2.0, 1.0), "NO2"),
             (four(9.0, None, 1.0, 1.0), "SO2"), (four(1.0, 1.0, 9.0, 1.0), "NO2"), (four(1.0, 1.0, 9.0, 9.0), "SO2")]
    df = R.add_pollution_source(readings(spark, *[c for c, _ in cases]))
    assert column(df, "primary_pollutant") == [p for _, p in cases]
    assert column(df, "pollution_source")[:4] == [
        "Vehicle/Industrial Emissions", "Construction/Dust", "Traffic Emissions", "Industrial Activity"]


def test_seasonal_factor(spark):
    df = R.add_pollution_source(readings(spark, *[{"season": s, "AQI": 100.0} for s in ("Winter", "Summer", "Autumn", None)]))
    assert column(df, "seasonal_adjusted_aqi") == [120.0, 90.0, 100.0, 100.0]


def test_alerts(spark):
    cases = [({"AQI": 300.1}, 1), ({"AQI": 300.0}, 2), ({"AQI": 300.0, "who_compliant_all": "Yes"}, 3),
             ({"AQI": 200.0}, 3), ({"AQI": 200.0, "pm25_exceeds_who": "No"}, 4), ({"AQI": 150.0}, 4),
             ({"AQI": 100.0}, 5), ({"AQI": None}, 5)]
    df = R.alerts(readings(spark, *[c for c, _ in cases]))
    assert column(df, "alert_priority") == [p for _, p in cases]
    assert column(df, "alert_message")[0] == " HAZARDOUS: Paris - Immediate action required!"
    assert df.filter("alert_timestamp is null").count() == 0
    assert R.urgent_alerts(df).transform(R.alert_view).columns == R.ALERT_VIEW
    assert R.urgent_alerts(df).count() == 4 and R.filter_critical(df).count() == 6


def test_validation_codes(spark):
    good = {"temp_c": 20.0, "humidity_pct": 50.0}
    cases = [
        ({}, []), ({"city": " "}, ["CITY_EMPTY"]), ({"city": None}, ["CITY_EMPTY"]),
        ({"country": ""}, ["COUNTRY_EMPTY", "TEMP_OUT_OF_RANGE_OR_UNKNOWN_COUNTRY"]),
        ({"country": None}, ["COUNTRY_EMPTY"]),
        ({"country": "Norway"}, ["TEMP_OUT_OF_RANGE_OR_UNKNOWN_COUNTRY"]),
        ({"temp_c": 50.0}, []), ({"temp_c": 50.1}, ["TEMP_OUT_OF_RANGE_OR_UNKNOWN_COUNTRY"]),
        ({"temp_c": float("nan")}, ["TEMP_OUT_OF_RANGE_OR_UNKNOWN_COUNTRY"]),
        ({"humidity_pct": 100.1}, ["HUMIDITY_INVALID"]), ({"humidity_pct": None}, ["HUMIDITY_INVALID"]),
        ({"wind_ms": -0.1}, ["WIND_INVALID"]), ({"AQI": 500.0}, []), ({"AQI": 500.1}, ["AQI_INVALID"]),
        ({"AQI": None}, ["AQI_INVALID"]), ({C.CORRUPT: "x"}, ["CSV_CORRUPT"]), ({C.CORRUPT: ""}, []),
        *[({p: v}, [f"{p.upper()}_INVALID"]) for p in C.POLLUTANTS for v in (-0.1, None, float("nan"))],
    ]
    df = readings(spark, *[{**good, **c} for c, _ in cases])
    labeled = V.label_errors(V.add_is_valid(df)).collect()
    assert [r["error_codes"] for r in labeled] == [codes for _, codes in cases]
    assert [r["error_code"] for r in labeled] == [codes[0] if codes else None for _, codes in cases]
    assert [r["is_valid"] for r in labeled] == [not codes for _, codes in cases]
    valid, invalid, _ = V.split_valid(df)
    assert valid.count() + invalid.count() == df.count() and "is_valid" not in valid.columns
    histogram = V.error_histogram(V.split_valid(df)[2]).collect()
    assert [r["count"] for r in histogram] == sorted((r["count"] for r in histogram), reverse=True)


def test_error_message_leaves_unknown_parts_out(spark):
    df = V.label_errors(readings(spark, {"country": None, "wind_ms": None, "co_ppm": None, "AQI": -5.0}))
    assert df.first()["error_message"] == (
        "failed validation | city=Paris | temp_c=1.0 | humidity=1.0 | AQI=-5.0 | pollutants=1.0,1.0,1.0,1.0,1.0")
