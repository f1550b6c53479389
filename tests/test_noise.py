"""The noisy file, line by line: expectations derived by hand from the cleaning rules."""

import pytest
from pyspark.sql import functions as F

from airlens import schema as S
from airlens.operators.standardize import standardize
from airlens.operators.validate import split_valid
from airlens.plans.cleaning import clean_readings, run_cleaning
from airlens.sources import read_csv
from tests.helpers import HEADER, NOISE, at


@pytest.fixture(scope="module")
def noise_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("noise") / "noise.csv"
    path.write_bytes(("\r\n".join([HEADER, *NOISE]) + "\r\n").encode())
    return str(path)


@pytest.fixture(scope="module")
def cleaned(spark, noise_file):
    df = standardize(read_csv(spark, noise_file))
    numbered = df.withColumn("_line", F.monotonically_increasing_id() + 2)
    return clean_readings(numbered, ["_line"]).cache()


@pytest.fixture(scope="module")
def by_line(cleaned):
    return {r["_line"]: r for r in cleaned.collect()}


def test_totals(spark, cleaned):
    valid, invalid, labeled = split_valid(cleaned)
    assert (cleaned.count(), valid.count(), invalid.count()) == (18, 17, 1)
    bad = labeled.first()
    assert bad["error_codes"] == ["CITY_EMPTY", "COUNTRY_EMPTY"] and bad["error_code"] == "CITY_EMPTY"
    assert bad["error_message"].startswith("failed validation | temp_c=20.0 | humidity=50.0 | ")


@pytest.mark.parametrize("line,expected", [
    (2, {"city": "Paris", "country": "France", "humidity_pct": 44.0}),   # of 44 and 58
    (3, {"country": "Egypt", "pm25_ugm3": 95.0}),                       # of 95 and 110
    (4, {"co_ppm": 1.1}),                                               # of 1.1 and 1.9
    (5, {"city": "São Paulo", "no2_ppb": 22.0, "hemisphere": "S", "season": "Winter"}),
    (6, {"pm25_ugm3": 19.0, "o3_ppb": 58.0}),
    (7, {"city": "Paris"}),
    (8, {"country": "Egypt"}),
    (9, {"ts": at("2023-06-15")}),                                      # a day after the row before in Delhi
    (10, {"o3_ppb": 45.0}),
    (11, {"so2_ppb": 11.0, "wind_ms": 2.2}),
    (12, {"pm10_ugm3": 71.0, "no2_ppb": 28.0}),
    (13, {"pm10_ugm3": 130.0}),
    (14, {"so2_ppb": 15.0, "humidity_pct": 57.0}),
    (15, {"temp_c": 17.0, "day_of_week": "Fri"}),
    (18, {"city": None, "country": None}),
    (19, {"temp_c": 28.0, "season": "Summer"}),
])
def test_line(by_line, line, expected):
    assert {k: by_line[line][k] for k in expected} == expected


def test_imputed_index(by_line):
    # PM2.5 decides: 80.5 lies in 55.5..150.4 for 151..200, and 40.5 in 35.5..55.4 for 101..150
    assert by_line[2]["AQI"] == pytest.approx(151 + 25 * 49 / 94.9, abs=1e-3)
    assert by_line[5]["AQI"] == pytest.approx(101 + 5 * 49 / 19.9, abs=1e-3)


def test_duplicate_day_is_removed(by_line):
    assert 15 in by_line and 16 not in by_line


def test_job_writes_valid_and_labelled(spark, noise_file, tmp_path):
    base = str(tmp_path / "out")
    run_cleaning(spark, noise_file, base, reader=read_csv)
    valid = spark.read.schema(S.CLEAN).json(f"{base}/valid_json")
    assert valid.count() == 17
    assert valid.filter("event_date is null or ts is null or season is null").count() == 0
    invalid = spark.read.json(f"{base}/invalid_labeled_json").collect()
    assert len(invalid) == 1 and invalid[0]["error_code"] == "CITY_EMPTY"
    run_cleaning(spark, noise_file, base, reader=read_csv, partition_by=["year", "month"])
    assert spark.read.schema(S.CLEAN).json(f"{base}/valid_json").count() == 17
