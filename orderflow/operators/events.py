"""Queries over the landed event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedupe_events(events: DataFrame) -> DataFrame:
    """One row per event id: the first published, ties by message id.

    The rank filter is also applied before the shuffle, so copies of one event do not pile up.
    """
    first = Window.partitionBy("event_id").orderBy("publish_time", "message_id")
    return events.withColumn("rn", F.row_number().over(first)).where("rn = 1").drop("rn")


def dedupe_stream(events: DataFrame, within: str = "10 minutes", key: str = "event_id") -> DataFrame:
    """Drops rows of a repeated ``key`` that arrive within ``within``, in a stream."""
    return events.withWatermark("publish_time", within).dropDuplicatesWithinWatermark([key])


def latency(events: DataFrame) -> DataFrame:
    """Seconds from business time to publish and from publish to ingestion, per event type."""

    def seconds(later: str, earlier: str):
        return (F.unix_micros(F.col(later)) - F.unix_micros(F.col(earlier))) / 1e6

    publish, ingest = seconds("publish_time", "event_time"), seconds("ingested_at", "publish_time")
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.avg(publish).alias("avg_publish_seconds"),
        F.max(publish).alias("max_publish_seconds"),
        F.avg(ingest).alias("avg_ingest_seconds"),
        F.max(ingest).alias("max_ingest_seconds"),
    )
