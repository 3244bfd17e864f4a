"""Store reference data: ``store_id,store_name,region,timezone``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.text import is_blank, trimmed
from orderflow.schemas import STORE_REFERENCE


def read_store_reference(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Reads the CSV; without a path the reference is empty and every lookup misses."""
    if path is None or not path.strip():
        return spark.createDataFrame([], STORE_REFERENCE)
    return require_unique(store_reference_from_lines(spark.read.text(path)))


def store_reference_from_lines(lines: DataFrame) -> DataFrame:
    """Splits plain text lines on commas (no quoting); skips header, blank and short lines."""
    cell = F.split("value", ",", -1)
    return (
        lines.where(~is_blank(F.col("value")))
        .where(~F.lower("value").startswith("store_id"))
        .where((F.size(cell) >= 2) & ~is_blank(F.get(cell, F.lit(0))))
        .select(*(trimmed(F.get(cell, F.lit(i))).alias(name) for i, name in enumerate(STORE_REFERENCE.names)))
    )


def require_unique(stores: DataFrame) -> DataFrame:
    """A store listed twice has no single answer: refuse the file rather than pick one."""
    twice = stores.groupBy("store_id").count().where("count > 1").select("store_id").take(1)
    if twice:
        raise ValueError(f"store reference lists store '{twice[0][0]}' more than once")
    return stores
