import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from airlens import config as C, schema as S
from airlens.operators.standardize import standardize
from airlens.sources import encode_records, read_csv, read_jsonl, read_lines, read_records, readings as R
from tests.helpers import HEADER, NOISE, at, plan_of, tuples


def test_schemas():
    assert S.RAW.names == S.TYPED.names == C.RAW_COLUMNS and len(S.RAW) == 13
    assert S.BATCH.names[-1] == C.CORRUPT and len(S.CLEAN) == 35


def test_bad_csv_line_keeps_its_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, NOISE[1], NOISE[2].replace("150", "lots")]))
    rows = read_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [r[C.CORRUPT] is None for r in rows] == [True, False]
    assert rows[1]["AQI"] is None and "lots" in rows[1][C.CORRUPT]


def test_bad_json_line_reaches_the_validator_column(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"Date": "1/2/2024", "AQI": 5, "City": "x"}) + "\n{broken\n")
    rows = read_jsonl(spark, str(tmp_path / "a.jsonl")).collect()
    assert rows[0]["AQI"] == 5.0 and rows[0][C.CORRUPT] is None and rows[1][C.CORRUPT] == "{broken"
    renamed = spark.read.schema("Date string, _corrupt_record string").json(str(tmp_path / "a.jsonl"))
    assert [r[C.CORRUPT] for r in standardize(renamed).collect()] == [None, "{broken"]


def test_quoted_numbers_are_read(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(json.dumps({"Date": "1/2/2024", "AQI": "5", "City": ""}) + "\n")
    row = standardize(read_jsonl(spark, str(tmp_path / "a.jsonl"), S.RAW_BATCH)).first()
    assert (row["ts"], row["AQI"], row["city"]) == (at("2024-02-01"), 5.0, "")


def test_encode_records(spark, tmp_path):
    header = "﻿Date , City,AQI"
    (tmp_path / "a.csv").write_text("\n".join([header, '1/1/2024,"New, York",5', "2/1/2024,", "3/1/2024,x,7,surplus", ""]),
                                    encoding="utf-8")
    assert read_lines(spark, str(tmp_path / "a.csv")).count() == 4
    lines = read_lines(spark, str(tmp_path / "a.csv"), header=True)
    got = [json.loads(r["value"]) for r in encode_records(lines, header).collect()]
    assert got == [{"Date": "1/1/2024", "City": "New, York", "AQI": "5"},
                   {"Date": "2/1/2024", "City": "", "AQI": None},
                   {"Date": "3/1/2024", "City": "x", "AQI": "7"}]
    bare = spark.createDataFrame([("a;b;",), ("c",)], "value string").coalesce(1)
    assert [json.loads(r["value"]) for r in encode_records(bare, delimiter=";").collect()] == [
        {"c0": "a", "c1": "b", "c2": ""}, {"c0": "c"}]


def test_encode_records_as_csv_does(spark, tmp_path):
    lines = ['q,"a ""b"" c",d', '"ab"c,"x', 'a"b,c"d"', "", ",", '"",""', ",".join(map(str, range(200))), '"with, comma" tail,z', "Date,City"]
    want = [next(csv.reader([line]), []) for line in lines]
    frame = spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1)
    got = [json.loads(r["value"]) for r in encode_records(frame).collect()]
    assert got == [{f"c{i}": cell for i, cell in enumerate(row)} for row in want]
    # a data row that equals the header is a row; the header is known by its place
    (tmp_path / "h.csv").write_text("Date,City\nDate,City\n  x ,\"y\"\n")
    rows = encode_records(read_lines(spark, str(tmp_path / "h.csv"), header=True), "Date,City").collect()
    assert [json.loads(r["value"]) for r in rows] == [{"Date": "Date", "City": "City"}, {"Date": "  x ", "City": "y"}]


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, "40")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_records_across_line_breaks_as_csv_reads_them(spark, tmp_path, small_splits):
    """Files of random pieces, read in splits of 40 bytes: quotes open and close anywhere, records span splits."""
    rng, pieces = random.Random(5), ['"', '""', '"', ",", "\n", "\n", "ab", "c d", "é", 'x"y', '","', '"\n"', "\n\n", "long words without any quote"]
    for case in range(6):
        folder, want = tmp_path / str(case), []
        folder.mkdir()
        for name in "ab":
            text = "".join(rng.choice(pieces) for _ in range(rng.randrange(150)))
            if not next(_records(text + "\n"))[1]:
                text += '"'
            (folder / f"{name}.csv").write_text(text + "\n", encoding="utf-8")
            want += [row for row, _ in _records(text + "\n")]
        frame = read_records(spark, str(folder))
        got = [json.loads(r["value"]) for r in encode_records(frame).collect()]
        key = lambda row: json.dumps(row, sort_keys=True)
        assert sorted(got, key=key) == sorted(({f"c{i}": cell for i, cell in enumerate(row)} for row in want), key=key)


def _records(text):
    """Rows as the csv module reads them, and whether the last one is closed; one that is open loses the file's last line break."""
    rows = list(csv.reader(io.StringIO(text, newline="")))
    closed = True
    if rows and rows[-1] and rows[-1][-1].endswith("\n"):
        again = list(csv.reader(io.StringIO(text[:-1] + '"\n', newline="")))
        if len(again) == len(rows) and again[-1][-1] == rows[-1][-1][:-1]:
            closed, rows = False, again
    for row in rows:
        yield row, closed


def test_records_header_limits_and_empty_files(spark, tmp_path, small_splits):
    for name in ("one", "two"):
        (tmp_path / f"{name}.csv").write_text('"id\nof it",text\r\n1,"a\r\nb"\r\n2,c\r\n')
    (tmp_path / "empty.csv").write_text("")
    got = [r["value"] for r in read_records(spark, str(tmp_path), header=True).collect()]
    assert sorted(got) == ['1,"a\nb"'] * 2 + ["2,c"] * 2
    (tmp_path / "open.csv").write_text('x,"' + "\n" * 30)
    with pytest.raises(Exception, match="more than 5 lines"):
        read_records(spark, str(tmp_path / "open.csv"), most_lines=5).collect()


def test_headerless_records_with_and_without_characters_that_json_escapes(spark):
    """Lines without any are put together without a map of their cells; both ways give the same text."""
    lines = ["a,,é b", ",", "x", "", 'q,"he said ""no""",z', "back\\slash,b", "tab\there,\u0001,\u007f,\u0085", '"a,b",c']
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")
    got = [r["value"] for r in encode_records(df.orderBy("i").coalesce(1).select("value")).collect()]
    want = [["a", "", "é b"], ["", ""], ["x"], [], ["q", 'he said "no"', "z"], ["back\\slash", "b"],
            ["tab\there", "\u0001", "\u007f", "\u0085"], ["a,b", "c"]]
    assert [json.loads(v) for v in got] == [{f"c{i}": x for i, x in enumerate(cells)} for cells in want]
    assert got[0] == '{"c0":"a","c1":"","c2":"é b"}'
    assert "array_join" in plan_of(encode_records(df.select("value")))


def test_readings_are_not_dealt_by_place(spark, tmp_path, monkeypatch):
    """Spark multiplies the sizes of suppliers and nations, and would shuffle all readings to meet a small table of places."""
    tables = {"nation": "SELECT id AS n_nationkey, id AS n_regionkey FROM range(5)",
              "supplier": "SELECT id AS s_suppkey, id % 6 AS s_nationkey, concat('S', id % 300) AS s_name FROM range(400)",
              "lineitem": "SELECT id AS l_orderkey, id % 7 AS l_partkey, id % 500 AS l_suppkey, CAST(1 AS INT) AS l_linenumber, DATE '2024-01-01' "
                          "AS l_shipdate, CAST(id AS DOUBLE) AS l_quantity, CAST(id AS DOUBLE) AS l_extendedprice FROM range(1000)"}
    for name, made in tables.items():
        spark.sql(made).write.parquet(f"{tmp_path}/{name}.parquet")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "1")      # as if all tables were large
    try:
        found = R.readings(spark, str(tmp_path))
        assert "SortMergeJoin [l_suppkey" not in plan_of(found) and "BroadcastHashJoin [l_suppkey" in plan_of(found)
        monkeypatch.setattr(R, "MOST_PLACES", 399)      # too many places to send around
        dealt = R.readings(spark, str(tmp_path))
        assert "SortMergeJoin [l_suppkey" in plan_of(dealt)
        assert tuples(found) == tuples(dealt) and found.count() == 668
    finally:
        spark.conf.set(limit, before)
