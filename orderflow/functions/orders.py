"""Order and line arithmetic over the parsed structs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow import schemas as S


def amount_of(quantity: Column, price: Column) -> Column:
    """Quantity times price, a missing factor counting as 0."""
    return F.coalesce(quantity, F.lit(0)) * F.coalesce(price, F.lit(0.0))


def line_count(lines: Column) -> Column:
    return F.when(lines.isNull(), 0).otherwise(F.size(lines)).cast("bigint")


def alteration_line_count(lines: Column) -> Column:
    altered = F.filter(lines, lambda line: line["fulfillmentType"] == S.ALTERATION)
    return F.when(lines.isNull(), 0).otherwise(F.size(altered)).cast("bigint")


def is_rental(order: Column) -> Column:
    """A rental by its type or by carrying a rental block."""
    return F.coalesce(order["orderType"] == S.RENTAL, F.lit(False)) | order["rental"].isNotNull()
