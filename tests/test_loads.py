"""Load jobs from stored clean readings, and queries on what they have stored."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from airlens import schema as S, shared
from airlens.catalog import live
from airlens.operators import graph as G
from airlens.plans.documents import load_documents
from airlens.plans.graph import load_graph
from airlens.sinks import read_graph, read_target, tables, write_validated
from tests.helpers import plan_of, tuples


def written(folder, rows, tail=""):
    """(city, country, day, AQI, pm25 flag) as clean readings in JSON lines."""
    folder.mkdir()
    lines = [json.dumps({"ts": day and f"{day} 00:00:00", "event_date": day, "city": city, "country": country, "AQI": aqi,
                         "aqi_category": "Good", "pm25_exceeds_who": flag}) for city, country, day, aqi, flag in rows]
    (folder / "part.json").write_text("\n".join([*lines, tail]))
    return str(folder)


@pytest.fixture
def two_loads(tmp_path):
    first = [("Paris", "F", "2024-01-01", 10.0, "Yes"), ("Paris", "F", "2024-01-01", 5.0, "Yes"), ("Oslo", "N", "2023-05-01", 3.0, "No")]
    second = [("Paris", "F", "2024-01-01", 99.0, "No"), ("Paris", "F", "2024-02-03", 30.0, "Yes"), (None, "F", "2024-02-03", 1.0, "No"),
              ("Paris", "F", None, 1.0, "No")]
    return written(tmp_path / "1", first), written(tmp_path / "2", second, '{"city": "cut o')


def test_documents_load(spark, two_loads, tmp_path):
    target = str(tmp_path / "documents")
    for batch, source in (("a", two_loads[0]), ("b", two_loads[1]), ("b", two_loads[1])):
        load_documents(spark, source, target, batch)
    stored = read_target(spark, target)
    assert tuples(stored, "dedup", "measurements.aqi", "month") == [
        ("None|F|2024-02-03 00:00:00", 1.0, "2024-02"), ("Oslo|N|2023-05-01 00:00:00", 3.0, "2023-05"),
        ("Paris|F|2024-01-01 00:00:00", 99.0, "2024-01"), ("Paris|F|2024-02-03 00:00:00", 30.0, "2024-02")]


def test_graph_load_and_queries_on_the_store(spark, two_loads, tmp_path):
    base = str(tmp_path / "graph")
    for batch, source in (("a", two_loads[0]), ("b", two_loads[1]), ("b", two_loads[1])):
        load_graph(spark, source, base, batch)
    whole = read_graph(spark, base)
    assert tuples(whole["reading"], "city", "AQI") == [("Oslo", 3.0), ("Paris", 30.0), ("Paris", 5.0)]
    assert whole["rejects"].count() == 3            # no city, no date, a line that is cut off
    january = read_graph(spark, base, "2024-01-01", "2024-01-31")
    assert tuples(january["reading"], "city", "AQI") == [("Paris", 5.0)]
    assert tuples(G.linked_readings(january, "2024-01-01", "2024-01-31"), "city", "AQI") == [("Paris", 5.0)]
    drivers = G.pollution_driver_of_cities(january, "2024-01-01", "2024-01-31")
    assert [tuple(r) for r in drivers.select("city", "pm25", "total_exceed").collect()] == [("Paris", 1, 1), ("Oslo", 0, 0)]
    assert G.pollution_driver_of_cities(january, "2024-01-01", "2024-01-31", limit=1).count() == 1
    same = G.pollution_driver_per_city(whole, "2024-01-01", "2024-01-31")
    assert tuples(drivers) == tuples(same.select(*drivers.columns))


def test_store_is_read_by_month(spark, two_loads, tmp_path, capsys):
    """Every table with a day is pruned to the months asked for."""
    base = str(tmp_path / "graph")
    for batch, source in zip("ab", two_loads, strict=True):
        load_graph(spark, source, base, batch)
    january = read_graph(spark, base, "2024-01-01", "2024-01-31")
    for name, keys in G.KEYS.items():
        if "event_date" in keys:
            files = january[name].select(F.input_file_name().alias("f")).distinct().collect()
            assert files and all("stored_month=2024-01/" in r["f"] for r in files), name
            january[name].explain()
            plan = capsys.readouterr().out
            assert "PartitionFilters: [isnotnull(stored_month" in plan, name


def test_half_a_load_is_not_followed(spark, two_loads, tmp_path):
    """A reading whose compliance node is not there yet is left out of linked readings, and comes in once the load is repeated."""
    base = str(tmp_path / "graph")
    load_graph(spark, two_loads[0], base, "a")
    stored = read_graph(spark, base)
    broken = stored | {"compliant": stored["compliant"].where("city <> 'Oslo'")}
    dates = ("2023-01-01", "2024-12-31")
    assert tuples(G.linked_readings(broken, *dates), "city") == [("Paris",)]
    assert tuples(G.linked_readings(stored, *dates), "city") == [("Oslo",), ("Paris",)]


def test_schema_of_loads_is_stated(spark, tmp_path):
    """A column that no line holds is null, not missing."""
    load_documents(spark, written(tmp_path / "1", [("Paris", "F", "2024-01-01", 10.0, "Yes")]), str(tmp_path / "d"), "a")
    row = read_target(spark, str(tmp_path / "d")).first()
    assert row["measurements"]["pollutants"]["co_ppm"] is None and "hemisphere" in S.CLEAN.names


def test_json_between_steps_is_compressed_and_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    """Plain JSON took 0.73 KB a reading; a compressed file is one task, so none may grow with the table."""
    monkeypatch.setattr(shared, "FILE_ROWS", 3)
    rows = spark.range(10, numPartitions=1).select("id", F.lit("x" * 50).alias("text"))
    write_validated(rows, rows.where("id < 4"), str(tmp_path))
    files = list((tmp_path / "valid_json").glob("part-*"))
    assert len(files) == 4 and all(f.name.endswith(".json.gz") for f in files)
    assert sorted(r["id"] for r in spark.read.schema("id long").json(str(tmp_path / "valid_json")).collect()) == list(range(10))
    assert spark.read.json(str(tmp_path / "invalid_labeled_json")).count() == 4


def test_a_table_as_a_stream_is_one_batch_however_many_files_it_has(spark, monkeypatch, tmp_path):
    """Rows come in no order of time: in a second batch, those of closed windows would be lost."""
    monkeypatch.setattr(shared, "FILE_ROWS", 1)
    day = lambda n: F.timestamp_seconds(F.lit(86400) * n)
    rows = spark.range(1200, numPartitions=1).select(day(1200 - F.col("id")).alias("ts"), F.lit("A").alias("city"), F.lit("B").alias("country"))
    empty = {f.name: F.lit(None).cast(f.dataType) for f in S.CLEAN if f.name not in rows.columns}
    monkeypatch.setattr(live, "enriched", lambda spark, sf: rows.withColumns(empty))
    stored = live._snapshot("one-batch", live.W.city_metrics, live.DAY, "append")(spark, "")
    assert stored.agg(F.sum("measurement_count")).first()[0] >= 2 * 1195


def test_a_load_deals_readings_once_and_joins_no_table_with_the_store(spark, two_loads, tmp_path, monkeypatch):
    """Nine tables were each joined with their stored keys and dealt by month on their own."""
    joined, kept = [], tables._existing
    monkeypatch.setattr(tables, "_existing", lambda spark, path, like: joined.append(path) or kept(spark, path, like))
    base, stage = str(tmp_path / "graph"), str(tmp_path / "stage")
    for batch, source in zip("ab", two_loads, strict=True):
        load_graph(spark, source, base, batch)
    assert len(joined) == sum("event_date" in keys for keys in G.KEYS.values())     # the first load asks what is there, later ones do not
    rows = spark.read.schema(S.CLEAN).json(two_loads[1]).withColumn("event_date", F.to_date("event_date"))
    again = G.build_graph(rows, S.CLEAN.names, stage=stage, known=tables.known_links(spark, base))
    assert not any(again[name].count() for name in G.KEYS)      # all of it is stored
    new = G.build_graph(rows.withColumn("aqi_category", F.lit("Fair")), S.CLEAN.names, stage=stage, known=tables.known_links(spark, base))
    assert new["reading"].count() == 0 and tuples(new["has_category"], "city", "aqi_category") == [("Paris", "Fair")] * 2


def test_a_load_is_not_dealt_by_month_before_it_is_dealt_by_part(spark, two_loads, tmp_path, monkeypatch):
    """The numbers of parts came as a table of unknown size, and all readings were shuffled by month to meet it."""
    planned, add = [], DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda df, *by: planned.append(plan_of(df)) or add(df, *by))
    rows = spark.read.schema(S.CLEAN).json(list(two_loads)).withColumn("event_date", F.to_date("event_date"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1")      # as if the load were large
    try:
        G.build_graph(rows, S.CLEAN.names, stage=str(tmp_path / "stage"))
    finally:
        spark.conf.set(limit, before)
    assert len(planned) == 1 and "Exchange hashpartitioning(stored_month" not in planned[0]


def test_a_load_that_broke_off_is_repaired_by_its_repeat(spark, two_loads, tmp_path, monkeypatch):
    """Tables that hold different loads are compared one by one, until the broken batch has ended."""
    base, add = str(tmp_path / "graph"), tables._add_keyed
    load_graph(spark, two_loads[0], base, "a")

    def broken(table, path, keys):
        if path.endswith("/category"):
            raise OSError("broke off")
        add(table, path, keys)

    monkeypatch.setattr(tables, "_add_keyed", broken)
    with pytest.raises(OSError):
        load_graph(spark, two_loads[1], base, "b")
    monkeypatch.setattr(tables, "_add_keyed", add)
    assert tables.known_links(spark, base) is None and read_graph(spark, base)["compliant"].count() == 2
    load_graph(spark, two_loads[0], base, "c")
    assert tables.known_links(spark, base) is None      # another batch does not mend it
    load_graph(spark, two_loads[1], base, "b")
    stored = read_graph(spark, base)
    assert tables.known_links(spark, base) is not None
    assert all(stored[name].count() == 3 for name in ("reading", "compliant", "has_reading", "on_day", "has_category", "has_compliant"))


def test_readings_of_a_frequent_place_and_day_are_cut_down_first(spark, two_loads, tmp_path, monkeypatch):
    """The result is the same whichever rows go which way, and however small the parts of a month are."""
    rows = spark.read.schema(S.CLEAN).json(list(two_loads)).withColumn("event_date", F.to_date("event_date"))
    rows = rows.withColumn("aqi_category", F.when(F.col("AQI") > 50, "Poor").otherwise("Good"))
    want = G.build_graph(rows, S.CLEAN.names)
    monkeypatch.setattr(G, "HOT_ROWS", 1)
    monkeypatch.setattr(G, "PART_ROWS", 1)
    keyed = rows.where("city IS NOT NULL AND event_date IS NOT NULL").select(
        *G.READING, G.month().alias("stored_month"), F.xxhash64(*G.READING).alias("_hash"))
    assert len(G._shares(keyed)[1]) == 1
    got = G.build_graph(rows, S.CLEAN.names, stage=str(tmp_path / "stage"))
    for name in G.KEYS:
        assert tuples(got[name]) == tuples(want[name]), name
