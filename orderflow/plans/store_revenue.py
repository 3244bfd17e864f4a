"""The revenue job: order lines in CSV text to one CSV of revenue per store."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from orderflow.operators.counters import count_lines
from orderflow.operators.revenue import read_cents, revenue_of_cents
from orderflow.sinks import write_csv_report
from orderflow.sources import read_order_csv

log = logging.getLogger(__name__)


def store_revenue(spark: SparkSession, source: str, target: str) -> dict:
    """Writes the report; returns how many lines were parsed and how many skipped."""
    counted, seen = count_lines(read_cents(read_order_csv(spark, source)))
    write_csv_report(revenue_of_cents(counted), target)
    log.info("order lines: %s", seen.get)
    return seen.get
