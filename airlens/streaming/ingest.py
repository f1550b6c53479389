"""Ingest: one message source, three outputs."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from airlens.sources.messages import (
    add_processing_time, clean_message_numbers, decode_raw, decode_typed,
)
from airlens.streaming import sinks


def preview(messages: DataFrame) -> DataFrame:
    """Decoded, cleaned rows with short names, as shown on the console."""
    keep = [c for c in ("topic",) if c in messages.columns]
    return decode_raw(messages, keep).transform(clean_message_numbers).transform(
        add_processing_time, "processed_at")


def start_ingest(messages: DataFrame, base: str, trigger: dict | None = None) -> dict[str, StreamingQuery]:
    """Console preview, raw CSV by day and batch, typed JSON. ``messages`` needs ``value``."""
    day = F.to_date("_day") if "timestamp" in messages.columns else None
    raw = decode_raw(messages.withColumn("_day", F.col("timestamp")), ["_day"]) if day is not None \
        else decode_raw(messages)
    return {
        "preview": sinks.to_console(preview(messages), rows=50, trigger=trigger, name="console_preview"),
        "raw": sinks.to_raw_csv(raw, f"{base}/raw_csv", f"{base}/checkpoints/raw_csv", trigger, day),
        "typed": sinks.to_json(decode_typed(messages), f"{base}/typed_json",
                               f"{base}/checkpoints/typed_json", trigger),
    }
