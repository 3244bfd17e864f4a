"""Joins that hold up when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def fits_broadcast(dim: DataFrame, rows: int = BROADCAST_ROWS, bytes_: int = BROADCAST_BYTES) -> bool:
    """Measures ``dim`` (never more than ``rows + 1`` of its rows) against the broadcast bounds."""
    width = F.octet_length(F.to_json(F.struct(*dim.columns)))
    seen = dim.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return seen["n"] <= rows and (seen["b"] or 0) <= bytes_


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: list[str],
    *,
    rows: int = BROADCAST_ROWS,
    salts: int = 32,
    small: bool | None = None,
) -> DataFrame:
    """Left join of many ``facts`` to at most one ``dim`` row per key.

    A dim measured to be small is broadcast: no shuffle of the facts. Beyond the bound the join
    is salted: each dim row is repeated once per salt and the facts of one key spread over all
    salts, so a hot key (or the null key) is shared by ``salts`` tasks. ``small`` states the
    result of an earlier measurement.
    """
    if fits_broadcast(dim, rows) if small is None else small:
        return facts.join(F.broadcast(dim), key, "left")
    salt = F.pmod(F.xxhash64(*spread_by) + F.spark_partition_id(), F.lit(salts)).cast("int")
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("_salt", salt).join(repeated, [key, "_salt"], "left").drop("_salt")
