import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from airlens.operators import clean, impute
from airlens.operators.standardize import canonicalize_headers, ensure_corrupt, fold_header, standardize
from tests.helpers import at, plan_of, tuples


def brute_fill(rows):
    """(id, country, city, ts) rows -> id: ts, by looking left and right row by row."""
    groups = {}
    for r in sorted(rows):
        groups.setdefault((r[1], r[2]), []).append(r)
    out = {}
    for group in groups.values():
        for i, r in enumerate(group):
            ts = r[3]
            if ts is None:
                before = [j for j in range(i) if group[j][3] is not None]
                after = [j for j in range(i + 1, len(group)) if group[j][3] is not None]
                near = before[-1] if before else after[0] if after else None
                if near is not None:
                    day = group[near][3].replace(hour=0, minute=0, second=0)
                    ts = day + timedelta(days=i - near)
            out[r[0]] = ts
    return out


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_fill_missing_date_matches_brute_force(spark, parts):
    """A hot place, NULL places and long runs of missing dates, over any number of ranges."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        place = rng.choice([("A", "hot")] * 5 + [("A", "x"), (None, "x"), ("B", None), (None, None)])
        known = rng.random() < (0.1 if place == ("A", "hot") else 0.5)
        rows.append((i, *place, datetime(2024, 1, 1, 5) + timedelta(days=rng.randrange(300)) if known else None))
    df = spark.createDataFrame(rows, "id long, country string, city string, ts timestamp").repartition(5)
    got = {r["id"]: r["ts"] for r in clean.fill_missing_date(df, ["id"], partitions=parts).collect()}
    assert got == brute_fill(rows)


def test_fill_missing_date_by_timestamp_order(spark):
    rows = [(at("2024-01-01 00:00:00"), "A", "x", at("2023-05-05 10:00:00")),
            (at("2024-01-01 00:00:01"), "A", "x", None), (at("2024-01-01 00:00:02"), "A", "x", None)]
    df = spark.createDataFrame(rows, "seen timestamp, country string, city string, ts timestamp")
    got = [r["ts"] for r in clean.fill_missing_date(df, ["seen"]).orderBy("seen").collect()]
    assert got == [at("2023-05-05 10:00:00"), at("2023-05-06"), at("2023-05-07")]
    texts = df.withColumn("seen", F.date_format("seen", "ss"))     # an order of any type
    assert [r["ts"] for r in clean.fill_missing_date(texts, ["seen"]).orderBy("seen").collect()] == got


def test_fill_missing_date_sums_up_by_rows(spark, tmp_path):
    """Places are cut by rows, not by values: a second a row apart or all at once, a place has a summary per range."""
    for name, seen in (("apart", F.timestamp_seconds(F.col("id") * 3600)), ("crowded", F.timestamp_micros(F.col("id")))):
        df = spark.range(20_000).select("id", seen.alias("seen"), F.lit("A").alias("country"), F.when(F.col("id") % 100 > 0, "hot").alias("city"),
                                        F.when(F.col("id") % 7 == 0, F.timestamp_seconds("id")).alias("ts"))
        dealt = clean.deal_dates(df, ["seen", "id"], ["country", "city"], str(tmp_path / name), 8)
        edges = clean.date_edges(dealt)
        assert 8 <= edges.count() <= 9                      # a row per range, and one more where a range has both places
        assert max(r["count"] for r in dealt.groupBy("_part").count().collect()) < 2 * 20_000 / 8


def test_guard_temp_by_a_table_as_by_a_map(spark):
    rows = [(n, country, temp) for n, (country, temp) in enumerate(
        (country, temp) for country in ("France", "Egypt", "Nowhere", None) for temp in (-90.0, -5.0, 30.0, 49.0, 80.0, None))]
    df = spark.createDataFrame(rows, "n int, country string, temp_c double")
    bounds = {"France": (-10.0, 40.0), "Egypt": (0.0, 50.0)}
    table = spark.createDataFrame([(k, *v) for k, v in bounds.items()], "place string, lowest double, highest double")
    for mode in ("nullify", "clip"):
        assert tuples(clean.guard_temp(df, mode, table)) == tuples(clean.guard_temp(df, mode, bounds))
        assert clean.guard_temp(df, mode, table).columns == df.columns
    half = spark.createDataFrame([("France", None, 40.0)], "place string, lowest double, highest double")
    assert tuples(clean.guard_temp(df.where("country = 'France'"), "nullify", half, (-95.0, 1.0)), "temp_c") == sorted(
        [(-90.0,), (-5.0,), (30.0,), (None,), (None,), (None,)], key=repr)


def test_fill_places_from_maps_and_tables(spark):
    rows = [(1, " cairo", None), (2, None, "France"), (3, None, None), (4, "Oslo", None), (5, "Paris", "USA")]
    df = spark.createDataFrame(rows, "id int, city string, country string")
    want = [(1, " cairo", "Egypt"), (2, "Paris", "France"), (3, None, None), (4, "Oslo", None), (5, "Paris", "USA")]
    assert tuples(df.transform(clean.fill_country).transform(clean.fill_city)) == want
    cities = spark.createDataFrame([("Cairo", "Egypt"), ("Oslo", "Norway")], "c string, l string")
    countries = spark.createDataFrame([("France", "Paris")], "l string, c string")
    filled = df.transform(clean.fill_country, cities).transform(clean.fill_city, countries)
    assert tuples(filled, "id", "city", "country") == [
        (1, " cairo", "Egypt"), (2, "Paris", "France"), (3, None, None), (4, "Oslo", "Norway"), (5, "Paris", "USA")]


def test_dedup_daily(spark):
    rows = [(3, "F", "P", at("2024-01-01 10:00:00")), (1, "F", "P", at("2024-01-01 23:00:00")),
            (2, "F", "P", at("2024-01-02")), (4, None, None, None), (5, None, None, None)]
    df = spark.createDataFrame(rows, "id int, country string, city string, ts timestamp")
    once = clean.dedup_daily(df, ["id"])
    assert [r[0] for r in tuples(once, "id")] == [1, 2, 4]
    assert tuples(clean.dedup_daily(once, ["id"])) == tuples(once)
    # Copies of a key are dropped before the shuffle.
    text = plan_of(once)
    assert text.index("WindowGroupLimit", text.index("Exchange")) > text.index("Exchange")


def guard_rows(spark):
    return spark.createDataFrame(
        [("Egypt", 4.9), ("Egypt", 5.0), ("Egypt", 55.0), ("Egypt", 55.1), ("Oslo", -90.0), ("Oslo", -90.1),
         (None, 60.1), (None, None)], "country string, temp_c double")


def test_guard_temp(spark):
    df = guard_rows(spark)
    assert [r[1] for r in df.transform(clean.guard_temp).collect()] == [
        None, 5.0, 55.0, None, -90.0, None, None, None]
    assert [r[1] for r in df.transform(clean.guard_temp, "clip").collect()] == [
        5.0, 5.0, 55.0, 55.0, -90.0, -90.0, 60.0, None]
    with pytest.raises(ValueError):
        df.transform(clean.guard_temp, "drop")


def test_other_guards(spark):
    df = spark.createDataFrame([(-0.1, -1.0), (0.0, 0.0), (100.0, 5.0), (100.1, None)],
                               "humidity_pct double, wind_ms double")
    assert [tuple(r) for r in df.transform(clean.guard_ranges).collect()] == [
        (None, None), (0.0, 0.0), (100.0, 5.0), (None, None)]
    assert [tuple(r) for r in df.transform(clean.guard_ranges, "clip").collect()] == [
        (0.0, 0.0), (0.0, 0.0), (100.0, 5.0), (100.0, None)]


def brute_median(values):
    known = sorted(v for v in values if v is not None)
    return known[(len(known) + 1) // 2 - 1] if known else None


def test_exact_medians_match_brute_force(spark):
    """A hot place, outliers, ties, negative values, zeros, constants and empty groups."""
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        city = rng.choice(["hot"] * 6 + ["b", "c", "d", None])
        a = rng.choice([None, rng.gauss(0, 1), rng.gauss(50, 10), 1e12, -1e12, float("inf"), float("-inf"), 0.0, 7.5])
        rows.append((rng.choice(["X", "X", "Y", None]), city, a, None if city == "c" else 4.0, rng.gauss(1e-6, 1e-9)))
    df = spark.createDataFrame(rows, "country string, city string, a double, b double, c double").repartition(6)
    got = {(r["level"], r["country"], r["city"], r["var"]): r["median"]
           for r in impute.level_medians(df, ["a", "b", "c"]).select("level", "scope.*", "var", "median").collect()}
    want = {}
    for i, var in ((2, "a"), (3, "b"), (4, "c")):
        scopes = {(0, x, y) for x, y, *_ in rows if x and y} | {(1, x, None) for x, *_ in rows if x} | {(2, None, None)}
        for level, x, y in scopes:
            median = brute_median([r[i] for r in rows if level == 2 or r[0] == x and (level == 1 or r[1] == y)])
            if median is not None:
                want[level, x, y, var] = median
    assert got == want


def test_crowded_values_are_narrowed(spark, monkeypatch):
    """Nearly all values crowd at one end of their range: no slot of the first cut is small enough."""
    monkeypatch.setattr(impute, "_MOST_VALUES", 50)
    monkeypatch.setattr(impute, "_SLOTS", 16)
    df = spark.range(3000).select(F.lit("x").alias("country"), F.lit("y").alias("city"), (F.col("id") / 3e9).alias("v"))
    df = df.union(spark.createDataFrame([("x", "y", 0.0155)], df.schema))
    assert {r["median"] for r in impute.level_medians(df, ["v"]).collect()} == {1500 / 3e9}


def test_medians_treat_nan_as_largest(spark):
    df = spark.createDataFrame([("X", "a", v) for v in (float("nan"), float("inf"), 1.0, float("nan"), 2.0)],
                               "country string, city string, v double")
    assert {r["median"] for r in impute.level_medians(df, ["v"]).collect()} == {float("inf")}


@pytest.mark.parametrize("approx", [False, True])
def test_impute_median_falls_back_level_by_level(spark, approx):
    rows = [("A", "x", 1.0), ("A", "x", 3.0), ("A", "x", None), ("A", "y", None), ("B", "z", None),
            (None, "x", None), ("A", None, None), ("A", "w", 9.0), ("A", "w", 9.0)]
    df = spark.createDataFrame(rows, "country string, city string, wind_ms double")
    got = [r["wind_ms"] for r in impute.impute_median(df, approx=approx).orderBy("country", "city", "wind_ms").collect()]
    # NULL country -> overall; A/NULL, A/y -> country; B -> overall; A/x -> city
    assert sorted(got) == sorted([3.0, 3.0, 9.0, 9.0, 1.0, 1.0, 3.0, 3.0, 3.0])
    assert impute.impute_median(df.drop("wind_ms")).columns == ["country", "city"]


def test_impute_aqi(spark):
    df = spark.createDataFrame([(None, 12.0, 100.0), (7.0, 12.0, 100.0), (None, None, None), (None, 12.05, 53.5)],
                               "AQI double, pm25_ugm3 double, no2_ppb double")
    assert [r["AQI"] for r in impute.impute_aqi(df).collect()] == [100.0, 7.0, None, None]
    single = df.select("AQI", "pm25_ugm3")
    assert [r["AQI"] for r in impute.impute_aqi(single).collect()] == [50.0, 7.0, None, None]


def test_headers(spark):
    assert fold_header(" PM2.5 (μg/m³) ") == "pm2.5 ug m3" and fold_header("Temperature (°C)") == "temperature degc"
    df = spark.createDataFrame([("a", "b", 1)], "`CITY` string, `_corrupt_record` string, other int")
    out = canonicalize_headers(df)
    assert out.columns == ["City", "_corrupt", "other"]
    clash = spark.createDataFrame([("a", "b")], "`pm2.5 ug m3` string, `PM2.5 (µg/m³)` string")
    assert canonicalize_headers(clash).columns == clash.columns
    assert ensure_corrupt(out) is out and ensure_corrupt(df).columns[-1] == "_corrupt"


def test_standardize_order_and_types(spark):
    df = spark.createDataFrame([("x", "7", "2024-02-01", " oslo ", "no")],
                               "`_corrupt_record` string, `no2-ppb` string, Date string, City string, Country string")
    out = standardize(df)
    assert out.columns == ["ts", "city", "country", "_corrupt", "no2_ppb"]
    assert tuple(out.first()) == (at("2024-02-01"), "Oslo", "NO", "x", 7.0)


def test_places_of_few_values_have_few_bands_and_exact_medians(spark):
    """A band is shuffled per place and variable: 500 values in 398 bands were nearly no fewer rows than the values."""
    values = spark.range(1, 501).select(F.col("id").cast("double").alias("v"), F.lit("A").alias("city"), F.lit("B").alias("country"))
    assert values.select(impute._band(F.col("v")).alias("b")).distinct().count() <= 100
    found = impute.level_medians(values, ["v"])
    assert {r["level"]: r["median"] for r in found.collect()} == {0: 250.0, 1: 250.0, 2: 250.0}


@pytest.mark.parametrize("most, join", [(1000, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_medians_of_few_places_are_broadcast_to_their_rows(spark, monkeypatch, most, join):
    """Beyond ten megabytes of medians all rows were dealt and sorted by place, once for the medians and once for the result."""
    monkeypatch.setattr(impute, "MOST_PLACES", most)
    rows = [(f"c{i % 7}" if i % 11 else None, f"x{i % 50}" if i % 13 else None, float(i % 97) if i % 5 else None) for i in range(600)]
    df = spark.createDataFrame(rows, "country string, city string, wind_ms double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        filled = impute.impute_median(df)
        assert plan_of(filled).count(join) == 2
        got = filled.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    known = lambda *at: brute_median([v for c, x, v in rows if (c, x)[:len(at)] == at])
    want = [(c, x, next(m for m in (v, known(c, x) if c and x else None, known(c) if c else None, known()) if m is not None)) for c, x, v in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_dates_deal_only_rows_without_one_and_parts_stay_small(spark, monkeypatch):
    """Rows with a date were dealt and sorted for a join that changes nothing in them, and 2 parts held all rows of any table."""
    monkeypatch.setattr(clean, "PART_ROWS", 40)
    rows = [(i, "X", "hot" if i % 3 else "y", at("2024-01-01") + timedelta(days=i) if i % 9 else None, "text" * 5) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, country string, city string, ts timestamp, note string")
    path = f"{spark.conf.get('spark.checkpoint.dir')}/small-parts"
    filled = clean.fill_missing_date(df, ["id"], partitions=2, stage=path)
    assert {r["id"]: r["ts"] for r in filled.collect()} == brute_fill([r[:4] for r in rows])
    parts = spark.read.parquet(path).groupBy("_part").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 90
    assert plan_of(filled.where("ts IS NOT NULL AND note IS NOT NULL").select("id", "note")).count("Union") == 1
