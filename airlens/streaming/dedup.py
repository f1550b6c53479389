"""Streaming duplicates."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from airlens.operators.clean import with_event_date


def dedup_daily_stream(df: DataFrame, late: str = "1 day",
                       keys: Sequence[str] = ("country", "city", "event_date")) -> DataFrame:
    """First reading per place and day within the watermark; older keys leave the state."""
    return with_event_date(df).withWatermark("ts", late).dropDuplicatesWithinWatermark([*keys])
