"""Messages for a topic: payload and attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_messages(messages: DataFrame, target: str, fmt: str = "json", mode: str = "append", **options: str) -> None:
    """Appends messages to a folder (``json``, ``parquet``) or sends them to a Kafka topic."""
    if fmt == "kafka":
        to_kafka(messages).write.format("kafka").option("topic", target).options(**options).save()
        return
    messages.write.mode(mode).format(fmt).options(**options).save(target)


def to_kafka(messages: DataFrame) -> DataFrame:
    """Message columns as Kafka sink columns; attributes become headers."""
    headers = F.transform(
        F.map_entries("attributes"),
        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
    )
    return messages.select(F.col("payload").cast("binary").alias("value"), headers.alias("headers"))
