"""Keeps costly expressions from being evaluated twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sealed(df: DataFrame, kept: list[str], *computed: Column) -> DataFrame:
    """``kept`` columns plus ``computed`` ones, which nothing above is merged with.

    A filter on a plain column is pushed below the projection that makes it, with the whole
    expression copied into the filter, once per mention; not so below a column that the optimizer
    takes for nondeterministic. (A generator is a barrier too, but evaluates its columns without
    generated code and copies every row twice.) Named columns only (aliases are kept).
    """
    made = df.select(*kept, *computed)
    always = F.spark_partition_id() >= 0
    return made.select(*kept, *(F.when(always, F.col(name)).alias(name) for name in made.columns[len(kept) :]))
