"""Revenue per store from order lines in CSV text, in whole cents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.functions.numbers import cents_text, to_cents
from orderflow.functions.text import is_blank, trimmed


def read_cents(lines: DataFrame) -> DataFrame:
    """``store_id`` and ``cents`` of each line; ``cents`` is null where the line is unusable."""
    cell = F.split("value", ",")
    content = lines.where(~is_blank(F.col("value")) & ~F.col("value").startswith("order_id"))
    return content.select(
        trimmed(F.get(cell, F.lit(1))).alias("store_id"), to_cents(F.get(cell, F.lit(2))).alias("cents")
    )


def parse_order_lines(lines: DataFrame) -> DataFrame:
    """Usable lines only: a missing column or an amount that is no number is skipped."""
    return _usable(read_cents(lines))


def _usable(cents: DataFrame) -> DataFrame:
    return cents.where(F.col("store_id").isNotNull() & F.col("cents").isNotNull())


def revenue_per_store(lines: DataFrame) -> DataFrame:
    """The revenue of each store's usable lines."""
    return revenue_of_cents(read_cents(lines))


def revenue_of_cents(read: DataFrame) -> DataFrame:
    """``store_id`` and ``revenue`` (text with two decimals).

    Sums combine map-side, as decimals: a few absurd amounts must not overflow and fail the job.
    """
    cents = F.sum(F.col("cents").cast("decimal(19,0)"))
    totals = _usable(read).groupBy("store_id").agg(cents.alias("cents"))
    return totals.select("store_id", cents_text(F.col("cents")).alias("revenue"))
