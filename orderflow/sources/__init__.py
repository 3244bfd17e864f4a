"""Readers for message streams, reference data, legacy extracts and landed tables."""

from orderflow.sources.landed import read_jsonl_events, read_order_events
from orderflow.sources.legacy import parse_legacy, read_legacy_extract
from orderflow.sources.messages import from_kafka, read_messages
from orderflow.sources.orders_csv import read_order_csv
from orderflow.sources.stores import read_store_reference, store_reference_from_lines

__all__ = [
    "from_kafka",
    "parse_legacy",
    "read_jsonl_events",
    "read_legacy_extract",
    "read_messages",
    "read_order_csv",
    "read_order_events",
    "read_store_reference",
    "store_reference_from_lines",
]
