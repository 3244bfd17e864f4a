"""Orders as CSV text for the revenue job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_order_csv(spark: SparkSession, path: str) -> DataFrame:
    """Plain lines (column ``value``); header and bad lines are sorted out when parsing."""
    return spark.read.text(path)
