from pyspark.sql import functions as F
import pytest

from airlens import config as C
from airlens.functions import (
    bucketize, clean_number, is_number, norm_city, norm_country, parse_ts, piecewise, safe_corr,
    stable_round,
)
from airlens.operators.impute import sub_index
from tests.helpers import at, many, one


def test_clean_number(spark):
    cells = ["", " ", "N/A", "n/a", "na", "NaN", "null", "—", "-", "12.5 µg", " -3 ", "1-2", "abc", None, "+7"]
    assert many(spark, clean_number, "string", cells) == [
        None, None, None, None, None, None, None, None, None, 12.5, -3.0, None, None, None, 7.0]


def test_names(spark):
    assert many(spark, norm_city, "string", ["  neW   york ", "são paulo", "", None]) == [
        "New York", "São Paulo", "", None]
    assert many(spark, norm_country, "string", [" usa", "uK ", "FrancE", "saudi  ARABIA", None]) == [
        "USA", "UK", "France", "Saudi Arabia", None]


def test_parse_ts(spark):
    cells = ["1/2/2024", "01/02/2024", "31/12/2024", "12/31/2024", "2024-03-04", "2024-03-04 05:06:07",
             "2/30/2024", "soon", "", None]
    assert many(spark, parse_ts, "string", cells) == [
        at("2024-02-01"), at("2024-02-01"), at("2024-12-31"), at("2024-12-31"), at("2024-03-04"),
        at("2024-03-04 05:06:07"), None, None, None, None]


def test_is_number(spark):
    assert many(spark, is_number, "double", [1.0, float("nan"), None]) == [True, False, False]


@pytest.mark.parametrize("cuts", [C.AQI_CUTS, *C.BUCKET_CUTS.values()])
def test_bucketize_at_each_cut(spark, cuts):
    values, expected = [None], [None]
    for i, cut in enumerate(cuts):
        values += [cut - 1e-6, float(cut), cut + 1e-6]
        expected += [C.QUALITY_LABELS[i], C.QUALITY_LABELS[i], C.QUALITY_LABELS[i + 1]]
    assert many(spark, lambda v: bucketize(v, cuts, C.QUALITY_LABELS), "double", values) == expected


@pytest.mark.parametrize("column", list(C.SUB_INDEX_SEGMENTS))
def test_sub_index_at_each_segment(spark, column):
    segments = C.SUB_INDEX_SEGMENTS[column]
    values = [None, -1.0, segments[-1][1] + 1]
    expected = [None, segments[0][2], segments[-1][3]]
    for low, high, index_low, index_high in segments:
        values += [low, high, (low + high) / 2]
        expected += [index_low, index_high, (index_low + index_high) / 2]
    got = many(spark, lambda v: piecewise(v, segments), "double", values)
    assert got[0] is None and got[1:] == pytest.approx(expected[1:])


def test_sub_index_between_segments(spark):
    assert one(spark, lambda: sub_index("pm25_ugm3"), pm25_ugm3=12.05) is None
    assert one(spark, lambda: sub_index("pm25_ugm3", contiguous=True), pm25_ugm3=12.05) == 50


def test_stable_round(spark):
    values = [0.125, 10.004999999999999, -0.125, None]
    assert many(spark, lambda v: stable_round(v, 2), "double", values) == [0.13, 10.01, -0.13, None]
    assert many(spark, lambda v: stable_round(v, 2, "even"), "double", [0.125, 0.375]) == [0.12, 0.38]


def test_safe_corr(spark):
    rows = [("a", 1.0, 2.0), ("a", 2.0, 4.5), ("a", 3.0, 5.0), ("a", None, 9.0), ("a", 7.0, None),
            ("const", 1.0, 2.0), ("const", 1.0, 3.0), ("single", 1.0, 1.0), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r["g"]: r["c"] for r in df.groupBy("g").agg(safe_corr(F.col("x"), F.col("y")).alias("c")).collect()}
    assert got["a"] == pytest.approx(df.filter("g = 'a'").agg(F.corr("x", "y")).first()[0])
    assert got["const"] is None and got["single"] is None and got["none"] is None
