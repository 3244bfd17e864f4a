"""Bounded samples of labelled rows for the models that are trained here."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def per_class(rows: DataFrame, class_column: str, limit: int) -> DataFrame:
    """At most ``limit`` rows of each class, by the hash of their ids.

    ``rows`` has ``id`` and the class only. A rank filter cuts each class within its tasks before the
    shuffle, so a class with most of the rows is no burden.
    """
    order = Window.partitionBy(class_column).orderBy(F.xxhash64("id"), "id")
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit).drop("_n")
