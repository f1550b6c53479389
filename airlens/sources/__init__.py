"""Readers: files, streams, messages, and the adapter over star-schema tables."""

from airlens.sources.files import read_csv, read_jsonl, read_lines, read_records, stream_json
from airlens.sources.messages import (
    add_processing_time, clean_message_numbers, decode_raw, decode_typed, encode_records,
    kafka_options, kafka_source,
)

__all__ = [
    "add_processing_time", "clean_message_numbers", "decode_raw", "decode_typed", "encode_records",
    "kafka_options", "kafka_source", "read_csv", "read_jsonl", "read_lines", "read_records", "stream_json",
]
