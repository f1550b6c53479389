"""Streams over files: what a stream gives equals what the table gives, but for open windows and late rows."""

import json
import os
from datetime import timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from airlens import config as C, schema as S
from airlens.operators import enrich as E, windows as W
from airlens.sources import kafka_options, kafka_source, stream_json
from airlens.sinks import versions
from airlens.streaming import sinks
from airlens.streaming.dedup import dedup_daily_stream
from airlens.streaming.ingest import preview, start_ingest
from airlens.streaming.live import results, start_live
from tests.helpers import at, tuples

ALL = {"availableNow": True}


def run(*queries):
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None


def write_files(spark, folder, batches):
    """One JSON file per batch of rows, in an order the file source keeps."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        path = os.path.join(folder, f"{i:03d}.json")
        with open(path, "w", encoding="utf-8") as out:
            out.writelines(json.dumps(r, ensure_ascii=False, default=str) + "\n" for r in rows)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


def reading(ts, aqi, city="a", **more):
    return {"ts": ts, "city": city, "country": "X", "AQI": aqi, "pm25_ugm3": aqi / 2, "pm10_ugm3": aqi,
            "no2_ppb": 5.0, "so2_ppb": 1.0, "temp_c": 20.0, "humidity_pct": 50.0, "wind_ms": 1.0,
            "season": "Winter", "who_compliant_all": "No", "pm25_exceeds_who": "Yes", **more}


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """Six files of minutes in order; the last one repeats an hour-old reading."""
    folder = str(tmp_path_factory.mktemp("feed"))
    start = at("2024-01-01 01:00:00")
    batches = [[reading(start + timedelta(minutes=10 * i + m), 100.0 + 10 * i + m, "ab"[m % 2]) for m in range(4)]
               for i in range(5)]
    batches.append([reading(start, 999.0)])
    write_files(spark, folder, batches)
    return folder


def table(spark, folder):
    return spark.read.schema(S.CLEAN).json(folder)


@pytest.mark.parametrize("aggregate", [W.city_metrics, W.country_trends, W.pollutant_correlations])
def test_complete_equals_batch(spark, feed, tmp_path, aggregate):
    out = str(tmp_path)
    run(sinks.to_snapshot(aggregate(stream_json(spark, feed)), f"{out}/d", f"{out}/c", "complete", ALL))
    got = sinks.read_snapshot(spark, f"{out}/d", "complete")
    assert tuples(got) == tuples(aggregate(table(spark, feed)))
    assert len([d for d in os.listdir(f"{out}/d") if d.startswith("batch_id=")]) == 3


def test_append_drops_late_rows_and_open_windows(spark, feed, tmp_path):
    out = str(tmp_path)
    run(sinks.to_snapshot(W.city_metrics(stream_json(spark, feed)), f"{out}/d", f"{out}/c", "append", ALL))
    got = sinks.read_snapshot(spark, f"{out}/d", "append")
    on_time = W.city_metrics(table(spark, feed).filter("AQI < 999"))
    newest = table(spark, feed).agg(F.max("ts")).first()[0]
    closed = on_time.filter(F.col("window_end") <= F.lit(newest - timedelta(minutes=2)))
    assert tuples(got) == tuples(closed)
    assert got.count() < on_time.count()


def test_update_snapshot_keeps_newest_row_per_window(spark, feed, tmp_path):
    out = str(tmp_path)
    run(sinks.to_snapshot(W.city_metrics(stream_json(spark, feed)), f"{out}/d", f"{out}/c", "update", ALL))
    got = sinks.read_snapshot(spark, f"{out}/d", "update", ["window_start", "city", "country"])
    assert tuples(got) == tuples(W.city_metrics(table(spark, feed).filter("AQI < 999")))


@pytest.mark.parametrize("mode", ["append", "update"])
def test_merged_batches_hold_the_same_rows(spark, feed, tmp_path, mode):
    out, keys = str(tmp_path), ["window_start", "city", "country"]
    for name, every in (("plain", 100), ("merged", 2)):
        run(sinks.to_snapshot(W.city_metrics(stream_json(spark, feed)), f"{out}/{name}", f"{out}/{name}-c", mode, ALL, merge_every=every))
    batches = len(os.listdir(f"{out}/plain"))
    assert len(os.listdir(f"{out}/merged")) < batches
    got = tuples(sinks.read_snapshot(spark, f"{out}/merged", mode, keys))
    assert got == tuples(sinks.read_snapshot(spark, f"{out}/plain", mode, keys)) and got


@pytest.mark.parametrize("mode, merge_every", [("append", 1), ("update", 1), ("update", 2)])
def test_replayed_batch_loses_and_doubles_nothing(spark, feed, tmp_path, mode, merge_every):
    """The newest batch runs again, as after a crash before its commit, also where its merge is done."""
    out, keys = str(tmp_path), ("window_start", "city", "country")
    start = lambda: run(sinks.to_snapshot(W.city_metrics(stream_json(spark, feed)), f"{out}/d", f"{out}/c", mode, ALL,
                                          merge_every=merge_every, keys=keys))
    shown = lambda: tuples(sinks.read_snapshot(spark, f"{out}/d", mode, keys))
    start()
    want, last = shown(), max(int(n) for n in os.listdir(f"{out}/c/commits") if n.isdigit())
    os.remove(f"{out}/c/commits/{last}")
    os.remove(f"{out}/c/commits/.{last}.crc")
    start()
    assert os.path.exists(f"{out}/c/commits/{last}") and shown() == want and want


def test_snapshot_ignores_half_written_folders(spark, feed, tmp_path):
    out, keys = str(tmp_path), ["window_start", "city", "country"]
    run(sinks.to_snapshot(W.city_metrics(stream_json(spark, feed)), f"{out}/d", f"{out}/c", "update", ALL, merge_every=3, keys=keys))
    want = tuples(sinks.read_snapshot(spark, f"{out}/d", "update", keys))
    kept = versions.complete(spark, f"{out}/d__merged", "upto")
    rows = spark.read.parquet(f"{out}/d__merged/upto={kept[-1]}")
    rows.limit(1).write.parquet(f"{out}/d__merged/upto=99")     # broke off before its marker
    rows.drop("batch_id").limit(1).write.parquet(f"{out}/d/batch_id=99")
    assert tuples(sinks.read_snapshot(spark, f"{out}/d", "update", keys)) == want
    assert rows.count() == rows.select(*keys).distinct().count()
    # a version that breaks off is written anew from what it was to replace
    os.remove(f"{out}/d__merged/upto={kept[-1]}/_complete")
    versions.merge(spark, f"{out}/d", kept[-1], keys)
    assert tuples(sinks.read_snapshot(spark, f"{out}/d", "update", keys)) == want


def test_dedup_expires_state(spark, tmp_path):
    day = at("2024-01-01 12:00:00")
    batches = [[reading(day + timedelta(days=i), 1.0), reading(day + timedelta(days=i), 2.0)] for i in range(20)]
    batches[3].append(reading(day + timedelta(days=2), 9.0))   # a copy from an earlier file
    write_files(spark, str(tmp_path / "in"), batches)
    stream = dedup_daily_stream(stream_json(spark, str(tmp_path / "in")))
    q = sinks.to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "c"), ALL)
    run(q)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 20 and got.select("event_date").distinct().count() == 20
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(kept) <= 4


def test_live_queries(spark, feed, tmp_path):
    queries = start_live(stream_json(spark, feed, max_files_per_trigger=100), str(tmp_path), ALL)
    run(*queries.values())
    assert set(queries) == {"city_metrics", "country_trends", "pollutant_correlations", "health_alerts",
                            "city_stats", "alert_log", "alert_preview"}
    assert not [t for t in spark.catalog.listTables() if t.name in queries]   # nothing is kept in the driver's memory
    data, stored = table(spark, feed), results(spark, str(tmp_path))
    closed = W.city_metrics(data).filter(F.col("window_end") <= F.lit(data.agg(F.max("ts")).first()[0] - timedelta(minutes=2)))
    assert tuples(stored["city_metrics"]) == tuples(closed)
    assert tuples(stored["city_stats"]) == tuples(W.city_stats(data))
    assert stored["health_alerts"].count() == data.count()
    log = spark.read.parquet(str(tmp_path / "alerts"))
    assert log.count() == data.filter("AQI > 150").count() > 0
    # A second run finds nothing new and repeats nothing.
    again = sinks.to_parquet(stream_json(spark, feed).select("ts"), str(tmp_path / "x"), str(tmp_path / "xc"), ALL)
    run(again)
    run(sinks.to_parquet(stream_json(spark, feed).select("ts"), str(tmp_path / "x"), str(tmp_path / "xc"), ALL))
    assert spark.read.parquet(str(tmp_path / "x")).count() == data.count()


# --- messages ------------------------------------------------------------------------
def message(**cells):
    return json.dumps({**dict.fromkeys(C.RAW_COLUMNS), "Date": "1/1/2024", "City": "Paris", **cells},
                      ensure_ascii=False).encode()


@pytest.fixture(scope="module")
def sent(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("messages"))
    values = [message(AQI="170", **{"PM2.5 (µg/m³)": "12.5 µg"}), message(AQI="1-2"), message(AQI=""),
              message(AQI="N/A"), b'{"Date": "1/1', json.dumps({"City": "Oslo"}).encode()]
    rows = [(v, "air", at("2024-03-01 10:00:00")) for v in values]
    spark.createDataFrame(rows, "value binary, topic string, timestamp timestamp").write.parquet(folder + "/in")
    return folder + "/in"


def test_preview(spark, sent):
    got = preview(spark.read.parquet(sent))
    assert got.columns == ["topic", "Date", "City", "Country", "AQI", "pm25", "pm10", "no2", "so2", "co", "o3",
                           "temp", "humidity", "wind", "processed_at"]
    assert tuples(got, "City", "AQI", "pm25") == sorted(
        [("Paris", 170.0, 12.5), ("Paris", None, None), ("Paris", None, None), ("Paris", None, None),
         (None, None, None), ("Oslo", None, None)], key=repr)


def test_ingest_writes_raw_and_typed(spark, sent, tmp_path):
    schema = spark.read.parquet(sent).schema
    for _ in range(2):      # a repeated start replays nothing
        stream = spark.readStream.schema(schema).parquet(sent)
        run(*start_ingest(stream, str(tmp_path), ALL).values())
    raw = spark.read.option("header", True).csv(str(tmp_path / "raw_csv"))
    assert raw.count() == 6 and raw.select("ingest_dt", "batch_id").distinct().count() == 1
    assert str(raw.first()["ingest_dt"]) == "20240301"
    typed = spark.read.schema(S.TYPED).json(str(tmp_path / "typed_json"))
    assert tuples(typed, "AQI") == sorted([(170.0,)] + [(None,)] * 5, key=repr)


def test_repeated_raw_batch_replaces_its_folder(spark, sent, tmp_path):
    """The same batch again, after its checkpoint was lost."""
    schema = spark.read.parquet(sent).schema
    for attempt in ("c1", "c2"):
        stream = spark.readStream.schema(schema).parquet(sent).select(F.col("value").cast("string"))
        run(sinks.to_raw_csv(stream, str(tmp_path / "raw"), str(tmp_path / attempt), ALL,
                             day=F.lit("2024-03-01").cast("date")))
    assert spark.read.option("header", True).option("quote", "").csv(str(tmp_path / "raw")).count() == 6


@pytest.mark.parametrize("sink", ["parquet", "json", "raw_csv"])
def test_replayed_file_batch_doubles_nothing(spark, feed, tmp_path, sink):
    """The newest batch runs again from the checkpoint, as after a crash between the sink's write and the commit."""
    out = str(tmp_path)
    stream = lambda: stream_json(spark, feed).select(F.col("ts").cast("string"), "city", F.col("AQI").cast("string"))
    more = {"day": F.lit("2024-01-01").cast("date")} if sink == "raw_csv" else {}
    start = lambda: run(getattr(sinks, f"to_{sink}")(stream(), f"{out}/d", f"{out}/c", ALL, **more))
    shape = "ts string, city string, AQI string"
    read = {"parquet": lambda: spark.read.parquet(f"{out}/d"), "json": lambda: spark.read.schema(shape).json(f"{out}/d"),
            "raw_csv": lambda: spark.read.option("header", True).csv(f"{out}/d")}[sink]
    start()
    want, last = tuples(read().select("ts", "city", "AQI")), max(int(n) for n in os.listdir(f"{out}/c/commits") if n.isdigit())
    os.remove(f"{out}/c/commits/{last}")
    os.remove(f"{out}/c/commits/.{last}.crc")
    start()
    assert os.path.exists(f"{out}/c/commits/{last}")
    assert tuples(read().select("ts", "city", "AQI")) == want and len(want) == table(spark, feed).count()


def test_memory_and_console(spark, feed):
    stream = stream_json(spark, feed, max_files_per_trigger=100)
    run(sinks.to_console(stream.select("city"), rows=2, trigger=ALL),
        sinks.to_memory(W.city_stats(stream), "stats", "complete", ALL))
    assert tuples(spark.table("stats")) == tuples(W.city_stats(table(spark, feed)))


def test_kafka_source_options(spark):
    assert kafka_options("h:9092", "air") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "air", "startingOffsets": "latest", "failOnDataLoss": "false"}
    with pytest.raises(AnalysisException, match="(?i)kafka"):   # the connector is not installed here
        kafka_source(spark, "h:9092", "air")
