"""Writers: partitioned tables, JSON lines, CSV reports and dead-letter messages."""

from orderflow.sinks.files import write_csv_report, write_jsonl
from orderflow.sinks.messages import write_messages
from orderflow.sinks.tables import append_stream, append_table, write_batch

__all__ = [
    "append_stream",
    "append_table",
    "write_batch",
    "write_csv_report",
    "write_jsonl",
    "write_messages",
]
