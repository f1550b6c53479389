"""Inputs the queries share."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from airlens import config as C
from airlens.catalog import sql
from airlens.operators import enrich as E
from airlens.sources.readings import ORDER, readings

#: raw record cells as text, messy on purpose; the same expressions run in both engines
_number = lambda c, noise: (
    f"CASE WHEN l_linenumber = 3 THEN 'N/A' WHEN l_linenumber = 5 THEN '—' WHEN l_linenumber = 6 THEN '1-2' "
    f"ELSE '{noise}' || CAST(CAST({c} AS DECIMAL(20,8)) AS STRING) || ' {noise}' END")
_part = lambda part: f"CAST({part}(ts) AS STRING)"
_pad = lambda part: f"lpad({_part(part)}, 2, '0')"
RAW_CELLS = {
    "Date": f"""CASE WHEN ts IS NULL THEN NULL
        WHEN l_linenumber % 4 = 0 THEN {_part('year')} || '-' || {_pad('month')} || '-' || {_pad('day')}
        WHEN l_linenumber % 4 = 1 THEN {_part('month')} || '/' || {_part('day')} || '/' || {_part('year')}
        WHEN l_linenumber % 4 = 2 THEN {_part('day')} || '/' || {_part('month')} || '/' || {_part('year')}
        ELSE 'someday' END""",
    "City": "'  ' || upper(replace(city, '#', '   nO ')) || ' '",
    "Country": "CASE WHEN l_linenumber % 2 = 0 THEN ' ' || lower(country) ELSE upper(country) END",
    "AQI": _number("AQI", ""),
    **{raw: _number(snake, "~") for raw, (snake, _) in C.HEADERS.items()},
}


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).transform(E.enrich, southern=sql.SOUTHERN)


def with_corrupt(df: DataFrame) -> DataFrame:
    return df.withColumn(C.CORRUPT, F.expr(sql.CORRUPT))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order columns and the 13 raw text cells."""
    return readings(spark, sf_dir).select(
        *ORDER, *[F.expr(cell).alias(name) for name, cell in RAW_CELLS.items()])


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order columns and binary JSON ``value``, all cells quoted; one line in 50 is cut off."""
    raw = raw_records(spark, sf_dir)
    value = F.to_json(F.struct(*[f"`{c}`" for c in C.RAW_COLUMNS]), {"ignoreNullFields": "false"})
    broken = F.col("l_partkey") % 50 == 7
    return raw.select(*ORDER, F.when(broken, F.substring(value, 1, 9)).otherwise(value)
                      .cast("binary").alias("value"))


def raw_sql(where_broken: str | None = None) -> str:
    """The raw cells as SQL; broken messages have none."""
    cell = lambda e: f"CASE WHEN {where_broken} THEN NULL ELSE {e} END" if where_broken else e
    cells = ", ".join(f'{cell(e)} AS "{name}"' for name, e in RAW_CELLS.items())
    return f"SELECT {sql.KEYS}, {cells} FROM readings"
