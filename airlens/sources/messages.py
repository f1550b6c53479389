"""Messages: the broker source, and records to and from JSON values."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from airlens import schema as S
from airlens.functions import to_double
from airlens.operators.standardize import clean_numbers, short_names


def kafka_options(bootstrap: str, topic: str, starting: str = "latest",
                  fail_on_data_loss: bool = False) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def kafka_source(spark: SparkSession, bootstrap: str, topic: str, starting: str = "latest",
                 fail_on_data_loss: bool = False, **extra) -> DataFrame:
    """Unbounded message table. Needs Spark's Kafka connector on the class path.

    A topic's partitions bound the read parallelism; ``minPartitions=...`` splits them further.
    """
    options = kafka_options(bootstrap, topic, starting, fail_on_data_loss) | extra
    return spark.readStream.format("kafka").options(**options).load()


def decode_raw(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Binary JSON ``value`` -> the 13 strings of a raw record (NULLs for malformed JSON)."""
    record = F.from_json(F.col("value").cast("string"), S.RAW)
    return df.select(*keep, record.alias("r")).select(*keep, "r.*")


def decode_typed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Binary JSON ``value`` -> 3 strings and 10 doubles.

    Producers may quote numbers, so all fields are read as text and then cast.
    """
    numbers = {f.name for f in S.TYPED if isinstance(f.dataType, T.DoubleType)}
    return decode_raw(df, keep).select(*keep, *[
        to_double(F.col(f"`{c}`")).alias(c) if c in numbers else F.col(f"`{c}`")
        for c in S.RAW.names])


def add_processing_time(df: DataFrame, name: str = "processing_time") -> DataFrame:
    """When the (micro-)batch ran."""
    return df.withColumn(name, F.current_timestamp())


def clean_message_numbers(df: DataFrame) -> DataFrame:
    """Decoded strings -> short names with cleaned numbers: the live preview's columns."""
    named = short_names(df)
    return clean_numbers(named, [c for c in named.columns if c not in ("Date", "City", "Country", "topic")])


def cells(line: Column, delimiter: str = ",") -> Column:
    """Array of a line's cells. A cell that starts with a quote runs to the closing one, or to the end of the line if
    there is none; doubled quotes inside stand for one, and what follows the closing quote belongs to the cell."""
    d = re.escape(delimiter)
    quoted = '"([^"]*+(?:""[^"]*+)*+)'
    found = F.regexp_extract_all(F.concat(F.lit(delimiter), line), F.lit(f'{d}(?:{quoted}(?:"[^{d}]*+|$)|[^{d}]*+)'), F.lit(0))
    cell = lambda x: F.substr(x, F.lit(len(delimiter) + 1))
    plain = F.split(line, d, -1)        # no quote: nothing to match cell by cell
    return F.when(line == "", F.array().cast("array<string>")).when(~F.contains(line, F.lit('"')), plain).otherwise(F.transform(found, lambda x: F.when(
        F.startswith(cell(x), F.lit('"')), F.concat(
            F.replace(F.regexp_extract(cell(x), f"^{quoted}", 1), F.lit('""'), F.lit('"')),
            F.regexp_extract(cell(x), f'(?s)^{quoted}"(.*)', 2))).otherwise(cell(x))))


def encode_records(lines: DataFrame, header: str | None = None, delimiter: str = ",") -> DataFrame:
    """Delimited text lines (``value``) -> one JSON object per line (``value``).

    With ``header`` (a header line, not part of ``lines``: see ``read_lines``): its names, trimmed of blanks and
    byte-order mark, are the keys; a short line is padded with nulls and surplus cells have no name. Of equal names the
    last counts. Without: keys are ``c0, c1, ...``, one for every cell a line has. An empty cell is an empty
    string, an empty line has no cells, a null line is left out.
    """
    parsed = lines.where(F.col("value").isNotNull()).select(
        cells(F.col("value"), delimiter).alias("cells"), F.col("value").rlike(r'["\\\p{Cntrl}]').alias("escapes"))
    if header is None:
        names = F.transform("cells", lambda x, i: F.concat(F.lit("c"), i.cast("string")))
        record = F.to_json(F.map_from_arrays(names, F.col("cells")))
        # cells without a character that JSON escapes are put into place as they are, which spares a map of each line
        cell = F.transform("cells", lambda x, i: F.concat(F.lit('"c'), i.cast("string"), F.lit('":"'), x, F.lit('"')))
        simple = F.concat(F.lit("{"), F.array_join(cell, ","), F.lit("}"))
        return parsed.select(F.when(F.col("escapes"), record).otherwise(simple).alias("value"))
    named = lines.sparkSession.range(1).select(cells(F.lit(header), delimiter).alias("n")).first()["n"]
    place = {name.strip("\ufeff").strip(): k for k, name in enumerate(named)}
    record = F.struct(*[F.get("cells", F.lit(k)).alias(name) for name, k in place.items()])
    return parsed.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value"))
