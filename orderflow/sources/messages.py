"""Message streams: payload, attributes, message id and publish time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.schemas import MESSAGE


def read_messages(
    spark: SparkSession,
    source: str,
    *,
    fmt: str = "parquet",
    stream: bool = False,
    **options: str,
) -> DataFrame:
    """Messages from a folder of envelope files (``parquet`` or ``json``) or a Kafka topic.

    The same function serves a stream and a table of landed messages. For ``kafka``, ``source``
    is the topic and the connection goes into ``options``.
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        return from_kafka(reader.format("kafka").option("subscribe", source)
                          .option("includeHeaders", "true").options(**options).load())
    return reader.schema(MESSAGE).options(**options).format(fmt).load(source)


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka source columns as the message envelope; headers become attributes."""
    headers = F.transform(
        F.coalesce(F.col("headers"), F.array().cast(records.schema["headers"].dataType)),
        lambda h: F.struct(h["key"].alias("key"), h["value"].cast("string").alias("value")),
    )
    # A header may be repeated; the last one counts, as in a map of attributes.
    last_of_each = F.filter(
        headers,
        lambda h, i: ~F.exists(
            F.slice(headers, i + 2, F.size(headers)), lambda later: later["key"] == h["key"]
        ),
    )
    return records.select(
        F.concat_ws("-", "topic", "partition", "offset").alias("message_id"),
        F.col("timestamp").alias("publish_time"),
        F.map_from_entries(last_of_each).alias("attributes"),
        F.col("value").cast("string").alias("payload"),
    )
