"""Counters taken while the data passes (``observe``): no second pass over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from orderflow import schemas as S


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` with one counter per condition; read them from the observation after an action."""
    observation = Observation(name)
    return df.observe(observation, *(F.count_if(c).alias(k) for k, c in counts.items())), observation


def count_parsed(judged: DataFrame, kind: str) -> tuple[DataFrame, Observation]:
    return observed(
        judged, kind, parsed=F.col("stage").isNull(), invalid=F.col("stage").isNotNull()
    )


def count_enriched(enriched: DataFrame) -> tuple[DataFrame, Observation]:
    found = F.col("store_name").isNotNull()
    return observed(enriched, "enrichment", enriched=found, store_not_found=~found)


def count_landed(judged: DataFrame) -> tuple[DataFrame, Observation]:
    """JSON lines read and skipped; blank ones are neither."""
    return observed(judged, "landed", lines_read=~F.col("skipped"), lines_skipped=F.col("skipped"))


def count_files(parsed_files: DataFrame) -> tuple[DataFrame, Observation]:
    observation = Observation("legacy")
    return (
        parsed_files.observe(
            observation,
            F.count_if(~F.col("failed")).alias("files_parsed"),
            F.count_if(F.col("failed")).alias("files_failed"),
            F.coalesce(F.sum(F.coalesce(F.size("orders"), F.lit(0))), F.lit(0)).alias("orders_parsed"),
        ),
        observation,
    )


def count_classes(results: DataFrame) -> tuple[DataFrame, Observation]:
    return observed(
        results, "reconciliation", **{c: F.col("classification") == c for c in S.CLASSIFICATIONS}
    )


def count_lines(cents: DataFrame) -> tuple[DataFrame, Observation]:
    usable = F.col("store_id").isNotNull() & F.col("cents").isNotNull()
    return observed(cents, "lines", parsed=usable, skipped=~usable)
