"""Registry of queries and helpers they share."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``(spark, sf_dir) -> DataFrame`` under ``name``, with its checking SQL."""
    def add(build):
        QUERIES[name] = lambda spark, sf_dir: at_edge(build(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build
    return add


def at_edge(df: DataFrame) -> DataFrame:
    """Result types both engines print alike: zone-free timestamps, dates as text."""
    shown = {T.TimestampType: "timestamp_ntz", T.DateType: "string"}
    return df.select(*[
        F.col(f"`{f.name}`").cast(shown[type(f.dataType)]).alias(f.name)
        if type(f.dataType) in shown else F.col(f"`{f.name}`") for f in df.schema])
