"""Ingest queries: messages, files, headers, dates and numbers as text."""

from pyspark.sql import functions as F

from airlens import config as C, schema as S
from airlens.catalog import sql
from airlens.catalog.inputs import enriched, messages, raw_records, raw_sql, with_corrupt
from airlens.catalog.registry import query
from airlens.functions import clean_number, norm_city, norm_country, parse_ts
from airlens.operators import standardize as ST
from airlens.operators.validate import split_valid
from airlens.shared import materialized, scratch_path, write_json
from airlens.sinks import write_validated
from airlens.sources import files, messages as M
from airlens.sources.readings import ORDER, readings
from airlens.streaming.ingest import preview

_BROKEN = "l_partkey % 50 = 7"
_RAW, _SENT = ("raw", raw_sql()), ("raw", raw_sql(_BROKEN))
_NUMBERS = ["AQI", *C.HEADERS]
_quoted = lambda columns: ", ".join(f'"{c}"' for c in columns)


@query("t1_02_decode_raw", sql.chain(_SENT, last=f"SELECT {sql.KEYS}, {_quoted(C.RAW_COLUMNS)} FROM raw"))
def t1_02(spark, sf):
    return M.decode_raw(messages(spark, sf), ORDER)


@query("t1_03_decode_typed", sql.chain(_SENT, last=(
    f'SELECT {sql.KEYS}, "Date", "City", "Country", '
    + ", ".join(f'TRY_CAST("{c}" AS DOUBLE) AS "{c}"' for c in _NUMBERS) + " FROM raw")))
def t1_03(spark, sf):
    return M.decode_typed(messages(spark, sf), ORDER)


_SHORT = {"AQI": "AQI", **{raw: brief for raw, (_, brief) in C.HEADERS.items()}}


def _clean_sql(c: str) -> str:
    sentinels = ", ".join(f"'{s}'" for s in C.NUMBER_SENTINELS)
    return (f'CASE WHEN trim("{c}") IN ({sentinels}) THEN NULL '
            f"""ELSE TRY_CAST(regexp_replace("{c}", '[^0-9+.-]', '', 'g') AS DOUBLE) END""")


_PREVIEW = '"Date", "City", "Country", ' + ", ".join(f"{_clean_sql(c)} AS {s}" for c, s in _SHORT.items())


@query("t1_04_short_names", sql.chain(_RAW, last=(
    f'SELECT {sql.KEYS}, "Date", "City", "Country", '
    + ", ".join(f'"{c}" AS {s}' for c, s in _SHORT.items()) + " FROM raw")))
def t1_04(spark, sf):
    return raw_records(spark, sf).transform(ST.short_names)


@query("t1_05_processing_time", sql.chain(last=f"SELECT {sql.KEYS}, TRUE AS stamped FROM readings"))
def t1_05(spark, sf):
    return readings(spark, sf).transform(M.add_processing_time).select(
        *ORDER, F.col("processing_time").isNotNull().alias("stamped"))


@query("k01_preview", sql.chain(_SENT, last=f"SELECT {_PREVIEW} FROM raw"))
def k01(spark, sf):
    return preview(messages(spark, sf)).drop("processed_at")


_LINE = ("CASE WHEN l_linenumber = 7 THEN CAST(l_orderkey AS STRING) "
         "ELSE CAST(l_orderkey AS STRING) || ',\"' || COALESCE(city, '') || '\",' || "
         "COALESCE(CAST(CAST(AQI AS DECIMAL(18,2)) AS STRING), '') END")
_AQI_TEXT = "COALESCE(CAST(CAST(AQI AS DECIMAL(18,2)) AS VARCHAR), '')"


@query("t1_06_encode_records", sql.chain(last=f"""SELECT CASE WHEN l_linenumber = 7
  THEN '{{"id":"' || l_orderkey || '","City":null,"AQI":null}}'
  ELSE '{{"id":"' || l_orderkey || '","City":"' || COALESCE(city, '') || '","AQI":"' || {_AQI_TEXT} || '"}}' END AS value
FROM readings"""))
def t1_06(spark, sf):
    lines = readings(spark, sf).select(F.expr(_LINE).alias("value"))
    return M.encode_records(lines, header="﻿id, City ,AQI")


@query("t1_06_encode_headerless", sql.chain(last=f"""SELECT CASE WHEN l_linenumber = 7
  THEN '{{"c0":"' || l_orderkey || '"}}'
  ELSE '{{"c0":"' || l_orderkey || '","c1":"' || COALESCE(city, '') || '","c2":"' || {_AQI_TEXT} || '"}}' END AS value
FROM readings"""))
def t1_06_headerless(spark, sf):
    return M.encode_records(readings(spark, sf).select(F.expr(_LINE).alias("value")))


_WIDE = """CASE WHEN l_linenumber = 1 THEN 'id,a,b' WHEN l_linenumber = 2 THEN CAST(l_orderkey AS STRING) || ',"say ""hi"", you",x'
  WHEN l_linenumber = 3 THEN CAST(l_orderkey AS STRING) || ',"open, "' WHEN l_linenumber = 4 THEN CAST(l_orderkey AS STRING) || ',"un, closed'
  ELSE repeat(CAST(l_linenumber AS STRING) || ',', CAST(l_orderkey % 200 AS INT)) || 'end' END"""


@query("t1_06_encode_wide", sql.chain(last="""SELECT CASE WHEN l_linenumber = 1 THEN '{"c0":"id","c1":"a","c2":"b"}'
  WHEN l_linenumber = 2 THEN '{"c0":"' || l_orderkey || '","c1":"say \\"hi\\", you","c2":"x"}'
  WHEN l_linenumber = 3 THEN '{"c0":"' || l_orderkey || '","c1":"open, "}' WHEN l_linenumber = 4 THEN '{"c0":"' || l_orderkey || '","c1":"un, closed"}'
  ELSE '{' || array_to_string(list_transform(range(l_orderkey % 200), lambda k: '"c' || k || '":"' || l_linenumber || '",'), '')
    || '"c' || (l_orderkey % 200) || '":"end"}' END AS value FROM readings"""))
def t1_06_wide(spark, sf):
    """Lines of 1 to 200 cells, doubled and unclosed quotes, and rows that look like a header."""
    return M.encode_records(readings(spark, sf).select(F.expr(_WIDE).alias("value")))


_BROKEN_LINES = '''CASE WHEN l_linenumber = 2 THEN l_orderkey || ',"first' || chr(10) || 'second, ""third""",x'
  WHEN l_linenumber = 3 THEN l_orderkey || ',"' || chr(10) || chr(10) || 'a"b,"' || chr(10) || '"'
  WHEN l_linenumber = 4 THEN l_orderkey || ',inch 5",x' WHEN l_linenumber = 5 THEN '"' || l_orderkey || '"y,"",'
  ELSE l_orderkey || ',plain,x' END'''


@query("t1_06_encode_multiline", sql.chain(last="""SELECT '{"id":"' || CASE WHEN l_linenumber = 5 THEN l_orderkey || 'y' ELSE CAST(l_orderkey AS VARCHAR) END
  || '","text":"' || CASE l_linenumber WHEN 2 THEN 'first\\nsecond, \\"third\\"' WHEN 3 THEN '\\n\\nab' WHEN 4 THEN 'inch 5\\"' WHEN 5 THEN '' ELSE 'plain' END
  || '","x":' || CASE l_linenumber WHEN 3 THEN '"\\n"' WHEN 5 THEN '""' ELSE '"x"' END || '}' AS value FROM readings"""))
def t1_06_multiline(spark, sf):
    """Files of records with line breaks in quoted cells, read in splits of 64 KB."""
    folder, limit = scratch_path(spark, "multiline"), "spark.sql.files.maxPartitionBytes"
    text = readings(spark, sf).select(F.expr(_BROKEN_LINES).alias("value"))
    text.write.text(f"{folder}/in")
    before = spark.conf.get(limit)
    spark.conf.set(limit, "65536")
    try:
        records = materialized(files.read_records(spark, f"{folder}/in"), f"{folder}/records")
    finally:
        spark.conf.set(limit, before)
    return M.encode_records(records, header="id,text,x")


# --- files -----------------------------------------------------------------------------
_MEASURED = ", ".join(f'{snake} AS "{raw}"' for raw, (snake, _) in C.HEADERS.items())


def _typed(spark, sf):
    """Records with typed numbers, for files."""
    return readings(spark, sf).select(
        F.date_format("ts", "yyyy-MM-dd").alias("Date"), F.col("city").alias("City"),
        F.col("country").alias("Country"), "AQI",
        *[F.col(snake).alias(raw) for raw, (snake, _) in C.HEADERS.items()])


_TYPED = f"""SELECT strftime(ts, '%Y-%m-%d') AS "Date", city AS "City", country AS "Country", AQI, {_MEASURED},
  CAST(NULL AS VARCHAR) AS _corrupt FROM readings"""


@query("t2_01_read_csv", sql.chain(last=_TYPED))
def t2_01(spark, sf):
    folder = scratch_path(spark, "csv")
    _typed(spark, sf).write.option("header", True).csv(folder)
    return files.read_csv(spark, folder)


@query("t2_02_read_jsonl", sql.chain(last=_TYPED))
def t2_02(spark, sf):
    folder = scratch_path(spark, "jsonl")
    write_json(_typed(spark, sf), folder)
    return files.read_jsonl(spark, folder)


@query("k04_valid_invalid_json", sql.chain(*sql.ENRICHED, ("flagged", sql.flagged("enriched")), last=(
    "SELECT CASE WHEN is_valid THEN 'valid' ELSE 'invalid' END AS part, city, country, ts, AQI, "
    "CASE WHEN is_valid THEN NULL ELSE nullif(split_part(error_codes, ',', 1), '') END AS error_code FROM flagged")))
def k04(spark, sf):
    base = scratch_path(spark, "validated")
    valid, _, labeled = split_valid(with_corrupt(enriched(spark, sf)))
    write_validated(valid, labeled, base)
    shape = "city string, country string, ts timestamp, AQI double, error_code string"
    parts = [spark.read.schema(shape).json(f"{base}/{folder}").select(F.lit(part).alias("part"), "*")
             for part, folder in (("valid", "valid_json"), ("invalid", "invalid_labeled_json"))]
    return parts[0].unionByName(parts[1])


# --- standardise --------------------------------------------------------------------------
_SPELLINGS = {
    "CITY": "city", "country": "country", "aqi": "AQI", "pm2.5_ug/m3": "pm25_ugm3",
    "PM10 (μg/m³)": "pm10_ugm3", "no2-ppb": "no2_ppb", "SO2 (PPB)": "so2_ppb", "CO  ppm": "co_ppm",
    "o3_(ppb)": "o3_ppb", "Temperature °C": "temp_c", "humidity": "humidity_pct",
    "wind speed (m/s)": "wind_ms", "corrupt record": "_corrupt",
}
_HEADED = {"City": "city", "Country": "country", "AQI": "AQI",
           **{raw: snake for raw, (snake, _) in C.HEADERS.items()}, C.CORRUPT: C.CORRUPT}


@query("c01_canonicalize_headers", sql.chain(last=f"SELECT {sql.KEYS}, " + ", ".join(
    f'{sql.CORRUPT if snake == C.CORRUPT else snake} AS "{raw}"' for raw, snake in _HEADED.items())
    + " FROM readings"))
def c01(spark, sf):
    messy = with_corrupt(readings(spark, sf)).select(
        *ORDER, *[F.col(snake).alias(name) for name, snake in _SPELLINGS.items()])
    return ST.canonicalize_headers(messy)


@query("c02_ensure_corrupt", sql.chain(last=f"SELECT {sql.KEYS}, CAST(NULL AS VARCHAR) AS _corrupt FROM readings"))
def c02(spark, sf):
    return readings(spark, sf).transform(ST.ensure_corrupt).select(*ORDER, C.CORRUPT)


@query("c03_snake_names", sql.chain(_RAW, last=f"SELECT {sql.KEYS}, " + ", ".join(
    f'"{raw}" AS {snake}' for raw, (snake, _) in C.HEADERS.items()) + " FROM raw"))
def c03(spark, sf):
    return raw_records(spark, sf).transform(ST.snake_names).select(
        *ORDER, *[snake for snake, _ in C.HEADERS.values()])


def _initcap(text: str) -> str:
    return (f"list_reduce(list_transform(string_split({text}, ' '), "
            "lambda w: upper(left(w, 1)) || lower(substr(w, 2))), lambda a, b: a || ' ' || b)")


_squeeze = lambda c: f"""regexp_replace(trim("{c}"), '\\s+', ' ', 'g')"""
_CITY = _initcap(_squeeze("City"))
_COUNTRY = (f"CASE WHEN length({_squeeze('Country')}) <= 3 THEN upper({_squeeze('Country')}) "
            f"ELSE {_initcap(_squeeze('Country'))} END")
_PARSED = """COALESCE(try_strptime("Date", '%d/%m/%Y'), try_strptime("Date", '%m/%d/%Y'),
  try_strptime("Date", '%Y-%m-%d'))"""


@query("c04_norm_city", sql.chain(_RAW, last=f"SELECT {sql.KEYS}, {_CITY} AS city FROM raw"))
def c04(spark, sf):
    return raw_records(spark, sf).select(*ORDER, norm_city(F.col("City")).alias("city"))


@query("c05_norm_country", sql.chain(_RAW, last=f"SELECT {sql.KEYS}, {_COUNTRY} AS country FROM raw"))
def c05(spark, sf):
    return raw_records(spark, sf).select(*ORDER, norm_country(F.col("Country")).alias("country"))


@query("c06_parse_ts", sql.chain(_RAW, last=f'SELECT {sql.KEYS}, "Date", {_PARSED} AS ts FROM raw'))
def c06(spark, sf):
    return raw_records(spark, sf).select(*ORDER, "Date", parse_ts(F.col("Date")).alias("ts"))


@query("c07_cast_numbers", sql.chain(_RAW, last=f'SELECT {sql.KEYS}, TRY_CAST("AQI" AS DOUBLE) AS AQI, ' + ", ".join(
    f'TRY_CAST("{raw}" AS DOUBLE) AS {snake}' for raw, (snake, _) in C.HEADERS.items()) + " FROM raw"))
def c07(spark, sf):
    return (raw_records(spark, sf).transform(ST.snake_names).transform(ST.cast_numbers)
            .select(*ORDER, *C.MEASUREMENTS))


@query("c08_clean_number", sql.chain(_RAW, last=f"SELECT {sql.KEYS}, " + ", ".join(
    f"{_clean_sql(c)} AS {s}" for c, s in _SHORT.items()) + " FROM raw"))
def c08(spark, sf):
    return raw_records(spark, sf).select(*ORDER, *[clean_number(F.col(f"`{c}`")).alias(s) for c, s in _SHORT.items()])


@query("c09_standardize", sql.chain(_RAW, last=(
    f"SELECT {_PARSED} AS ts, {_CITY} AS city, {_COUNTRY} AS country, {sql.KEYS}, "
    'TRY_CAST("AQI" AS DOUBLE) AS AQI, ' + ", ".join(
        f'TRY_CAST("{raw}" AS DOUBLE) AS {snake}' for raw, (snake, _) in C.HEADERS.items())
    + ", CAST(NULL AS VARCHAR) AS _corrupt FROM raw")))
def c09(spark, sf):
    return raw_records(spark, sf).transform(ST.standardize)
