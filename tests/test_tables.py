"""Documents, graph and dashboard over tables."""

import os

import pytest
from pyspark.sql import functions as F

from airlens.operators import dashboard as B, documents as D, graph as G, windows as W
from airlens.sinks import read_graph, read_target, tables, upsert_by_key, write_graph
from tests.helpers import at, tuples


def docs(spark, rows):
    """(city, ts, aqi, pm25, season) -> documents."""
    df = spark.createDataFrame(rows, "city string, ts timestamp, AQI double, pm25_ugm3 double, season string")
    return D.to_document(df.withColumn("country", F.lit("X")))


def test_document_shape(spark):
    rows = [(1, "x", None, at("2024-01-02 03:04:05"), None), (2, None, "Y", at("2024-01-02 03:04:05.25"), "S"),
            (3, "x", "Y", None, "S")]
    df = spark.createDataFrame(rows, "id int, city string, country string, ts timestamp, hemisphere string")
    made = D.to_document(df, keep=["id"])
    assert [r["dedup"] for r in made.orderBy("id").collect()] == [
        "x|None|2024-01-02 03:04:05", "None|Y|2024-01-02 03:04:05.250000"]
    assert made.columns == ["id", "ts_utc", *D.LAYOUT, "dedup"]
    assert made.filter("id = 1").select(F.to_json("location")).first()[0] == '{"city":"x"}'


def test_ts_utc_from_text(spark):
    rows = [("2024-01-02T03:04:05Z", "2020-01-01"), (None, "2020-01-01"), ("?", "2020-01-01"), ("?", "?")]
    df = spark.createDataFrame(rows, "ts string, event_date string").coalesce(1)
    assert [r["ts_utc"] for r in D.add_ts_utc(df).collect()] == [
        at("2024-01-02 03:04:05"), at("2020-01-01"), at("2020-01-01"), None]
    assert D.keep_document_columns(D.add_ts_utc(df)).columns == ["ts_utc"]


def test_seasonal_profile_ranks_with_ties(spark):
    data = [("a", at("2024-01-01"), 1.0, v, s) for s, v in
            [("Winter", 5.0), ("Winter", 7.0), ("Spring", 6.0), ("Summer", 1.0), ("Autumn", None), (None, 2.0)]]
    profile = D.seasonal_pm25_profile(docs(spark, data))
    assert tuples(profile) == [("a", "Spring", 2, 6.0, 2), ("a", "Summer", 3, 1.0, 1), ("a", "Winter", 1, 6.0, 2)]
    assert [tuple(r) for r in D.season_by_city(profile, ["a"]).collect()] == [("Winter", 6.0), ("Spring", 6.0), ("Summer", 1.0)]
    assert D.season_by_city(profile, ["a", "z"]).columns == ["season", "a", "z"]
    assert [tuple(r) for r in D.city_by_season(profile).collect()] == [("a", 6.0, 6.0, 1.0, None)]


def test_half_even_rounding(spark):
    made = docs(spark, [("a", at("2024-01-01"), 0.125, 1.0, "Winter")])
    assert D.monthly_avg_aqi_mom(made).first()["avg_aqi"] == 0.13
    assert D.monthly_avg_aqi_mom(made, half="even").first()["avg_aqi"] == 0.12


def test_month_over_month(spark):
    made = docs(spark, [("a", at("2024-01-05"), 10.0, 1.0, "w"), ("a", at("2024-01-09"), 20.0, 1.0, "w"),
                        ("a", at("2024-02-01"), 10.5, 1.0, "w"), ("a", at("2024-07-01"), None, 1.0, "w"),
                        ("a", at("2024-09-01"), 30.0, 1.0, "w"), ("b", at("2024-09-01"), 1.0, 1.0, "w")])
    changes = D.monthly_avg_aqi_mom(made)
    assert tuples(changes, "city", F.month("month"), "mom_change_aqi") == [
        ("a", 1, None), ("a", 2, -4.5), ("a", 9, 19.5), ("b", 9, None)]
    assert tuples(D.monthly_avg_aqi_mom(made, "next"), "city", F.month("month"), "mom_change_aqi") == [
        ("a", 1, 4.5), ("a", 2, -19.5), ("a", 9, None), ("b", 9, None)]
    assert tuples(D.mom_direction(changes), "mom_change_aqi", "direction") == [
        (-4.5, "improved"), (0.0, "worse"), (0.0, "worse"), (19.5, "worse")]
    assert [r[0] for r in D.cities(changes).collect()] == ["a", "b"]


def test_upsert(spark, tmp_path):
    target = str(tmp_path / "docs")
    frame = lambda rows: spark.createDataFrame(rows, "dedup string, ts_utc timestamp, v int")
    shown = lambda: tuples(read_target(spark, target), "dedup", "v", "month")
    upsert_by_key(frame([("a", at("2024-01-01"), 1), ("b", at("2024-02-01"), 2), ("a", at("2024-01-01"), 0)]),
                  target, "1", ["v"])
    assert shown() == [("a", 0, "2024-01"), ("b", 2, "2024-02")]
    january = {f.name for f in (tmp_path / "docs" / "month=2024-01").iterdir()}
    second = frame([("b", at("2024-02-01"), 5), ("c", at("2024-02-09"), 6)])
    for _ in range(2):
        upsert_by_key(second, target, "2", ["v"])
        assert shown() == [("a", 0, "2024-01"), ("b", 5, "2024-02"), ("c", 6, "2024-02")]
    # A month the batch does not touch keeps its files.
    assert january == {f.name for f in (tmp_path / "docs" / "month=2024-01").iterdir()}


def test_upsert_keeps_documents_without_time_and_follows_moved_keys(spark, tmp_path):
    target = str(tmp_path / "docs")
    frame = lambda rows: spark.createDataFrame(rows, "dedup string, ts_utc timestamp, v int")
    shown = lambda: tuples(read_target(spark, target), "dedup", "v", "month")
    upsert_by_key(frame([("k1", None, 1), ("k2", at("2024-01-01"), 2), ("k4", at("2024-03-01"), 4)]), target, "1", ["v"])
    upsert_by_key(frame([("k3", None, 3)]), target, "2", ["v"])
    assert shown() == [("k1", 1, "none"), ("k2", 2, "2024-01"), ("k3", 3, "none"), ("k4", 4, "2024-03")]
    upsert_by_key(frame([("k1", at("2024-02-01"), 5), ("k4", at("2024-02-02"), 6)]), target, "3", ["v"])
    assert shown() == [("k1", 5, "2024-02"), ("k2", 2, "2024-01"), ("k3", 3, "none"), ("k4", 6, "2024-02")]


@pytest.fixture(scope="module")
def graph_rows(spark):
    """(n, country, city, day, aqi, category, pm25 flag, o3 flag)"""
    rows = [(1, "F", "Paris", "2024-01-01", 10.0, "Good", "Yes", "No"),
            (2, "F", "Paris", "2024-01-01", 99.0, "Moderate", "No", "No"),
            (3, "F", "Paris", "2024-01-02", 20.0, "Good", "Yes", "Yes"),
            (4, "U", "Paris", "2024-01-02", 70.0, "Moderate", "No", "Yes"),
            (5, "U", "Cairo", "2023-05-01", 400.0, "Hazardous", "Yes", "Yes"),
            (6, None, "Oslo", "2024-01-01", 1.0, "Good", "No", "No"),
            (7, "N", "Oslo", "2024-01-01", None, None, "No", "No")]
    df = spark.createDataFrame(rows, "n int, country string, city string, day string, AQI double, "
                                     "aqi_category string, pm25_exceeds_who string, o3_exceeds_who string")
    given = set(df.columns) | {"event_date"}
    extra = {c for attributes in G.ATTRIBUTES.values() for c in attributes} - given | {"day"}
    return df.withColumn("event_date", F.to_date("day")).withColumns({c: F.lit(None).cast("string") for c in extra})


@pytest.mark.parametrize("staged", [False, True])
def test_graph_tables(spark, graph_rows, tmp_path, staged):
    g = G.build_graph(graph_rows, ["n"], stage=str(tmp_path / "stage") if staged else None)
    assert tuples(g["city"], "country", "city") == [("F", "Paris"), ("U", "Cairo"), ("U", "Paris")]
    assert g["day"].count() == 3 and g["reading"].count() == 4 and g["category"].count() == 3
    assert tuples(g["reading"].filter("city = 'Paris' and country = 'F'"), "AQI") == [(10.0,), (20.0,)]
    assert g["has_category"].count() == 5 and g["has_reading"].count() == 4
    assert [r[0] for r in tuples(g["rejects"], "n")] == [6, 7]


def test_undated_tables_keep_few_files_over_many_loads(spark, graph_rows, tmp_path, monkeypatch):
    """Forty loads, each with a city of its own, and each load twice: all cities once, in a bounded number of folders."""
    base, keys = str(tmp_path / "g"), G.KEYS["city"]
    city = G.build_graph(graph_rows, ["n"])["city"]
    for n in range(40):
        named = spark.createDataFrame([("F", "Paris"), ("L", f"city {n}")], "country string, city string")
        table = named.select(*[F.col(c) if c in named.columns else F.lit(None).cast("string").alias(c) for c in city.columns])
        for _ in range(2 if n % 5 == 0 else 1):
            tables._add_keyed(table, base, keys)
    stored = tables._keyed(spark, base)
    assert stored.count() == 41 == stored.select(*keys).distinct().count()
    folders = os.listdir(base) + os.listdir(f"{base}__merged")
    assert len(folders) <= 2 * tables.MERGE_LOADS + 2
    # a load that broke off before its marker is not there, and the next one takes its place
    table.write.parquet(f"{base}/batch_id=40")
    assert tables._keyed(spark, base).count() == 41


def test_graph_queries(graph_rows):
    g = G.build_graph(graph_rows, ["n"])
    top = G.top_cities_by_avg_aqi(g, "2024-01-01", "2024-01-02", k=2)
    assert [tuple(r) for r in top.collect()] == [("Paris", "U", 70.0), ("Paris", "F", 15.0)]
    drivers = G.pollution_driver_per_city(g)
    # Cairo has no reading in 2024, yet is listed.
    assert [tuple(r) for r in drivers.select("country", "city", "pm25", "o3", "total_exceed").collect()] == [
        ("F", "Paris", 2, 1, 3), ("U", "Paris", 0, 1, 1), ("U", "Cairo", 0, 0, 0)]
    assert G.pollution_driver_per_city(g, limit=1).count() == 1
    ranks = G.rank_pollutants(drivers).filter("country = 'F'").orderBy("pollutant_rank")
    assert [r["pollutant"] for r in ranks.collect()] == ["pm25", "o3", "pm10", "no2", "so2", "co"]


def test_stored_graph_keeps_first_values(spark, graph_rows, tmp_path):
    base = str(tmp_path / "graph")
    later = graph_rows.withColumn("AQI", F.col("AQI") + 1000)
    for part in (graph_rows.filter("n <= 3"), later, later):
        write_graph(G.build_graph(part, ["n"]), base, "1")
    stored = read_graph(spark, base)
    assert tuples(stored["reading"], "AQI") == [(10.0,), (1070.0,), (1400.0,), (20.0,)]
    assert stored["has_reading"].count() == 4


def test_dashboard(spark):
    stats = spark.createDataFrame([("a", "X", 0.0, 5.0, 2), ("b", "X", 10.0, 50.0, 1), ("c", "X", 0.4, 1.0, 1),
                                   ("d", "X", 9.6, 9.9, 1), ("e", "X", None, None, 3)],
                                  "city string, country string, avg_aqi double, max_aqi double, count long")
    bins = {r["bin"]: r["n"] for r in B.aqi_histogram(stats).collect()}
    assert len(bins) == 20 and bins[0] == 2 and bins[19] == 2 and sum(bins.values()) == 4
    same = B.aqi_histogram(stats.filter("city = 'b'")).filter("n > 0").collect()
    assert [(r["bin"], r["n"]) for r in same] == [(10, 1)]
    assert [r["city"] for r in B.top_city_stats(stats, 2).collect()] == ["b", "d"]
    alerts = spark.createDataFrame([(f"c{i}", float(i * 60), i % 3 + 1, "m", "Good" if i % 2 else "Bad", at(f"2024-01-0{i}"))
                                    for i in range(1, 8)],
                                   "city string, AQI double, alert_priority int, alert_message string, "
                                   "health_risk_label string, alert_timestamp timestamp")
    assert [r["city"] for r in B.latest_alerts(alerts, 2, k=3).collect()] == ["c7", "c6", "c4"]
    assert B.latest_alerts(alerts).columns == ["city", "AQI", "health_risk_label"]
    assert tuples(B.risk_distribution(alerts)) == [("Bad", 3, 42.9), ("Good", 4, 57.1)]
    assert tuple(B.summary(stats, alerts).first()) == (5, 5.0, 50.0, 4)


def test_windows_on_daily_readings(spark):
    rows = [(at("2024-01-01"), "a", "X", 100.0, 1.0, "No"), (at("2024-01-01"), "a", "X", 201.0, 2.0, "Yes"),
            (at("2024-01-02"), "a", "X", None, 3.0, "No")]
    df = spark.createDataFrame(rows, "ts timestamp, city string, country string, AQI double, pm25_ugm3 double, "
                                     "who_compliant_all string")
    df = df.withColumns({c: F.lit(1.0) for c in ("pm10_ugm3", "no2_ppb", "temp_c", "humidity_pct")})
    city = W.city_metrics(df).orderBy("window_start")
    assert city.count() == 4      # each minute lies in two windows
    assert tuple(city.select("avg_aqi", "max_aqi", "measurement_count", "who_violations").first()) == (150.5, 201.0, 2, 1)
    trend = W.country_trends(df, "1 day", "1 day").orderBy("window_start").collect()
    assert [(r["hazardous_count"], r["unhealthy_count"], r["unhealthy_percentage"], r["median_aqi"], r["aqi_stddev"])
            for r in trend] == [(1, 1, 50.0, 100.0, 71.42), (0, 0, 0.0, None, None)]
    corr = W.pollutant_correlations(df, "1 day", "1 day").orderBy("window_start").collect()
    assert [(r["pm25_aqi_corr"], r["pm10_aqi_corr"]) for r in corr] == [(1.0, None), (None, None)]
    assert tuples(W.city_stats(df)) == [("a", "X", 150.5, 201.0, 3)]
    assert B.top_cities(W.city_metrics(df), 1).first()["avg_aqi"] == 150.5
    assert B.top_countries(W.country_trends(df), 1).first()["hazardous_count"] == 1


def test_an_upsert_deals_documents_by_month_once(spark, tmp_path, monkeypatch):
    """A batch is joined by key, so dealing it by month before the merge was a shuffle of all its documents for nothing."""
    dealt, stage = [], tables._stage
    monkeypatch.setattr(tables, "_stage", lambda df, path: dealt.append(path) or stage(df, path))
    rows = "dedup string, ts_utc timestamp, v int"
    for batch, part in (("1", [("a", at("2024-01-05"), 1), ("b", None, 2)]), ("2", [("a", at("2024-02-05"), 3), ("c", at("2024-01-07"), 4)])):
        tables.upsert_by_key(spark.createDataFrame(part, rows), str(tmp_path / "docs"), batch, ["v"])
    stored = tables.read_target(spark, str(tmp_path / "docs"))
    assert tuples(stored, "dedup", "v", "month") == [("a", 3, "2024-02"), ("b", 2, "none"), ("c", 4, "2024-01")]
    assert len(dealt) == 1 and dealt[0].endswith("/merged")
