"""Parquet tables, partitioned by day and by batch, and sorted inside files on the cluster column.

Every write has a batch of its own and overwrites that partition alone. Spark then stages its files apart, by job;
plain appends to one path share a temporary folder, which the first of two parallel writers to commit removes.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from orderflow.schemas import Table


#: Places that days are dealt to where adaptive execution joins the small ones: few days share one, so that few have a
#: file in each part of a place that is split.
PLACES = 1000


def _laid_out(df: DataFrame, table: Table, day: Column | None) -> DataFrame:
    """Adds the day column and arranges rows for few, sorted files per day.

    ``rebalance`` sends a day to one place only as long as it is small: adaptive execution splits
    a large day over as many tasks as its size asks for. The parts of a split place hold rows of all its days, so
    places are many; without adaptive execution (in micro-batches) the session says how many.
    """
    source = day if day is not None else F.col(table.day_of)
    dated = df.withColumn(table.day, F.to_date(source))
    order = [table.day] + ([table.cluster_by] if table.cluster_by else [])
    adaptive = df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    places = [PLACES] if adaptive else []
    return dated.hint("rebalance", *places, F.col(table.day)).sortWithinPartitions(*order)


def _day_column(table: Table) -> Column | None:
    # Without a column of its own the table is partitioned by the day of writing.
    return None if table.day_of else F.current_date()


def append_table(df: DataFrame, table: Table, root: str) -> None:
    """Appends rows of the table's types to ``root/<table>``, creating it if needed."""
    write_batch(df, table, root, "append", exactly_once=False)


def write_batch(
    df: DataFrame, table: Table, root: str, batch: str, day: Column | None = None, exactly_once: bool = True
) -> None:
    """Writes one batch, for example a micro-batch of a stream.

    Exactly-once: the rows go to the partition of ``batch``, which a repeated attempt overwrites; ``day`` must
    then not depend on the clock. Otherwise each attempt has a partition of its own, and a repeated one may
    repeat rows. Any number of writers may write to one table at the same time.
    """
    laid_out = _laid_out(df.select(*table.schema.names), table, day if day is not None else _day_column(table))
    name = batch if exactly_once else f"{batch}-{uuid.uuid4().hex}"
    writer = laid_out.withColumn("batch", F.lit(name)).write.partitionBy(table.day, "batch")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{table.name}")


def append_stream(
    df: DataFrame,
    table: Table,
    root: str,
    checkpoint: str,
    exactly_once: bool = True,
    interval: str = "10 seconds",
) -> DataStreamWriter:
    """A stream writer for one table; call ``start()`` on it.

    Exactly-once uses the file sink, which records the files of each batch; readers then see only
    files of this sink, so the table must have no other writer. At-least-once appends in
    ``foreachBatch``. ``interval`` is the time between flushes.
    """
    day = _day_column(table)
    rows = df.select(*table.schema.names)
    if exactly_once:
        dated = rows.withColumn(table.day, F.to_date(F.col(table.day_of) if day is None else day))
        writer = dated.writeStream.format("parquet").partitionBy(table.day).option("path", f"{root}/{table.name}")
    else:
        writer = rows.writeStream.foreachBatch(lambda batch, _: append_table(batch, table, root))
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval)


def replace_day(df: DataFrame, table: Table, root: str, day: str, batch: str | None = None) -> None:
    """Writes the rows of one day (``yyyy-MM-dd``) over those of earlier runs: a clean re-run of a date.

    The day is emptied if there are no rows. With ``batch`` only that batch of the day is written over. Rows of
    other days are refused.
    """
    moment = F.lit(datetime.date.fromisoformat(day))
    rows = _laid_out(df.select(*table.schema.names), table, F.col(table.day_of) if table.day_of else moment)
    same = F.assert_true(F.col(table.day).eqNullSafe(moment), F.lit(f"a row of {table.name} is not of {day}"))
    # The check is part of a column that is written, so it is not pruned.
    first = table.schema.names[0]
    checked = rows.withColumn(first, F.when(same.isNull(), F.col(first))).drop(table.day)
    path = f"{root}/{table.name}/{table.day}={day}"
    if batch is None:
        writer = checked.withColumn("batch", F.lit("clean")).write.partitionBy("batch")
    else:
        writer, path = checked.write, f"{path}/batch={batch}"
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
